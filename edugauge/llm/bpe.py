"""Byte-level BPE as a lazily determinised finite-state transducer.

A token sequence is the BPE encoding of its bytes exactly if each pair of neighbours is, so the encoding of a text is
found from left to right: after every byte exactly one token can end the encoding of what has been read so far, the
longest suffix that is a token and a valid neighbour of the token that ends where it starts. Only starts within the
longest suffix that begins some token can matter later; they are the *live* ends. A state of the transducer holds, for
each live end, the tokens of its encoding that are not emitted yet. Tokens on which all live encodings agree are
emitted, after a lookahead of at most one token length. States and transitions are built when a text first needs them and kept
in a table of bounded size, which starts anew when it is full; the output never depends on that.

Matches of the pattern are encoded one by one, as the pattern splits the text; the output of frequent matches is kept, in two
generations of bounded bytes.

Decoding looks up the bytes of each id. Runs of tokens that hold whole characters are passed on at once; all others
step an incremental UTF-8 state machine byte by byte, which holds the bytes of an unfinished character until the next token and
replaces what can never become one by U+FFFD.

Defined cases: a null text has no tokens, and null ids decode to the empty text. Repeated rows are encoded again. Texts
of any length are streamed match by match. Ids outside the vocabulary raise. Columns of the table are kept, but for
those that the result writes.
"""

from __future__ import annotations

import base64
import gc
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from edugauge.llm.common import keep_columns, map_arrow, quoted, slices

#: Transitions kept in a worker; a full table starts anew.
MAX_TRANSITIONS = 800_000
#: Bytes of the outputs of matches kept in a worker, about, in each of two generations.
MATCH_BYTES = 64_000_000

NEVER = 1 << 60

_built: dict[tuple, object] = {}


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64 rank``; ``path`` may be a driver's file or any URI that Spark reads."""
    if "://" in path:
        lines = [r["value"].encode() for r in spark.read.text(path).collect()]  # one vocabulary
    else:
        with open(path, "rb") as file:
            lines = file.read().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """Encoder of single matches for one vocabulary.

    A state is the last token emitted, if the next step can still depend on it (else -1), and the ids of the tokens pending at each
    live end, from left to right. A transition is a number made of the next state and the place of its output.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.spines: dict[bytes, tuple[tuple[int, ...], tuple[int, ...]]] = {}
        self.prefixes = {token[:n] for token in ranks for n in range(1, len(token) + 1)}
        self.longest = max(map(len, ranks))
        self.unreached = {token for token in ranks if not self._reached(token)}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.parts: list[tuple] = []
        self.steps: dict[int, int] = {}
        self.outputs: dict[tuple[int, ...], int] = {(): 0}
        self.output: list[tuple[int, ...]] = [()]
        self._intern((-1, ()))

    def _reached(self, token: bytes) -> bool:
        """Whether merging the token's bytes gives the token, by ranks that rise from the parts to the whole."""
        parts, last = [token[i : i + 1] for i in range(len(token))], {}
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                return False
            merged = parts[at] + parts[at + 1]
            if max(last.get(parts[at], -1), last.get(parts[at + 1], -1)) > rank:
                raise ValueError(f"token {token!r} has a lower rank than its parts")
            last[merged] = rank
            parts[at : at + 2] = [merged]
        return True

    def _spines(self, token: bytes) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Pieces at the right and at the left edge of a token while it is merged, from single bytes to the token: of each its
        length and the rank at which it grows into the next one, in turn.
        """
        known = self.spines.get(token)
        if known is None:
            parts = [token[i : i + 1] for i in range(len(token))]
            right, left = [], []
            while len(parts) > 1:
                rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if at == len(parts) - 2:
                    right += [len(parts[-1]), rank]
                if at == 0:
                    left += [len(parts[0]), rank]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.spines[token] = ((*right, len(token), NEVER), (*left, len(token), NEVER))
        return known

    def _neighbours(self, left: bytes, right: bytes) -> bool:
        """Whether merging ``left + right`` never merges across the border.

        The edge pieces on both sides grow in the order of their ranks; a merge across the border happens if its rank comes
        before the next growth on either side (a growth on the left goes first among equals, one on the right last).
        """
        rank, border, both = self.ranks.get, len(left), left + right
        ours, theirs = self._spines(left)[0], self._spines(right)[1]
        i = j = 0
        while True:
            grow, other = ours[i + 1], theirs[j + 1]
            across = rank(both[border - ours[i] : border + theirs[j]], NEVER)
            if across < grow and across <= other:
                return False
            if grow > other:
                j += 2
            elif grow < NEVER:
                i += 2
            else:
                return True

    def _intern(self, state: tuple) -> int:
        number = self.states.get(state)
        if number is None:
            number = self.states[state] = len(self.parts)
            self.parts.append(state)
        return number

    def _step(self, number: int, byte: int) -> int:
        """Transition of a state. Its text is the longest suffix that begins a token, with an end at each position; the last token
        before an end is its last pending one, or else the last one emitted.
        """
        emitted, *ends = self.parts[number]
        tokens, rank = self.tokens, self.ranks.get
        text = b"".join(map(tokens.__getitem__, ends[-1]))
        text = text[len(text) - len(ends) + 1 :] + bytes((byte,))
        for start, pending in enumerate(ends):
            token = text[start:]
            found = rank(token)
            if found is not None and token not in self.unreached:
                last = pending[-1] if pending else emitted
                if last < 0 or self._neighbours(tokens[last], token):
                    break
        else:
            raise ValueError(f"the vocabulary cannot encode byte {byte}")
        cut, prefixes = max(0, len(text) + 1 - self.longest), self.prefixes
        while cut < len(text) and text[cut:] not in prefixes:
            cut += 1
        ends = [*ends[cut:], (*pending, found)]
        first, shared, common = ends[0], 0, min(map(len, ends))
        while shared < common and all(pending[shared] == first[shared] for pending in ends):
            shared += 1
        if shared:
            ends = [pending[shared:] for pending in ends]
            emitted = first[shared - 1]
        if common > shared:
            emitted = -1
        place = 0
        if shared:
            out = first[:shared]
            place = self.outputs.get(out)
            if place is None:
                place = self.outputs[out] = len(self.output)
                self.output.append(out)
        return self._intern((emitted, *ends)) << 24 | place

    def encode(self, data: bytes) -> list[int]:
        """Ids of one match."""
        steps, state, ids = self.steps, 0, []
        for byte in data:
            key = state << 8 | byte
            step = steps.get(key)
            if step is None:
                if len(steps) >= MAX_TRANSITIONS:
                    kept = self.parts[state]
                    self._reset()
                    steps, state = self.steps, self._intern(kept)
                    key = state << 8 | byte
                step = steps[key] = self._step(state, byte)
            state, place = step >> 24, step & 0xFFFFFF
            if place:
                ids.extend(self.output[place])
        ids.extend(self.parts[state][-1])
        return ids


class _Matches(dict):
    """Output of frequent matches as packed ids. A full generation becomes the old one; what is met again moves to the young one."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer, self.old, self.bytes = transducer, {}, 0

    def __missing__(self, match: str) -> bytes:
        packed = self.old.get(match)
        if packed is None:
            ids = self.transducer.encode(match.encode("utf-8", "replace"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(match) <= 32:
            self.bytes += 200 + 2 * len(match) + len(packed)
            if self.bytes > MATCH_BYTES:
                self.old, self.bytes = dict(self), 0
                self.clear()
            self[match] = packed
        return packed


def ascii_pattern(pattern: str) -> re.Pattern | None:
    """The pattern with its Unicode classes narrowed to ASCII, for the faster standard engine; None if it has others."""
    narrow, inside, out, i = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r"\t-\r "}, False, [], 0
    while i < len(pattern):
        found = next((c for c in narrow if pattern.startswith(c, i)), None)
        if found:
            out.append(narrow[found] if inside else f"[{narrow[found]}]")
            i += len(found)
        elif pattern.startswith(r"\S", i) and not inside:
            out.append(r"[^\t-\r ]")
            i += 2
        elif pattern[i] == "\\":
            if pattern[i + 1] in "pPSdDwWbB":
                return None
            out.append(pattern[i : i + 2])
            i += 2
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out.append(pattern[i])
            i += 1
    return re.compile("".join(out), re.ASCII)


def _identity(ranks: dict[bytes, int]) -> tuple:
    """What tells one vocabulary from another within an application."""
    return len(ranks), hash(frozenset(ranks.items()))


def _encoder(ranks: dict[bytes, int], pattern: str, identity: tuple | None = None) -> tuple[Callable[[str], list[str]], _Matches]:
    """One encoder for each vocabulary and pattern in a Python worker."""
    key = ("encoder", identity or _identity(ranks), pattern)
    if key not in _built:
        split = regex.compile(pattern).findall
        plain = ascii_pattern(pattern)
        plain = plain.findall if plain else split
        _built[key] = (lambda text: plain(text) if text.isascii() else split(text), _Matches(Transducer(ranks)))
    return _built[key]


def _packer(identity: tuple, ranks: dict[bytes, int], pattern: str) -> Callable[[pa.Array], list[bytes]]:
    """Texts to packed ids."""
    split, matches = _encoder(ranks, pattern, identity)

    def pack(texts: pa.Array) -> list[bytes]:
        gc.disable()  # the tables hold no cycles, and walking through them again and again takes as long as building them
        try:
            return [b"".join(map(matches.__getitem__, split(t.as_py() or ""))) for t in texts]
        finally:
            gc.enable()

    return pack


def _add(docs: DataFrame, source: Column, gone: str, added: dict[str, T.DataType], function: Callable[[], Callable[[pa.Array], list[list]]]) -> DataFrame:
    """Columns of ``docs`` but ``gone``, plus what ``function``, made once in a task, gives for ``source``."""
    kept = keep_columns(docs, gone, *added)
    plain = docs.select(*kept, source.alias("__llm_source"))
    types = [to_arrow_type(kind) for kind in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = function()
        for batch in slices(batches):
            columns = [pa.array(values, kind) for values, kind in zip(work(batch.column(batch.num_columns - 1)), types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *added])

    return map_arrow(plain, run, T.StructType([*plain.schema.fields[:-1], *(T.StructField(name, kind) for name, kind in added.items())]))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` without the text, plus ``ids`` (binary: little-endian unsigned 32-bit integers)."""
    shared, identity = docs.sparkSession.sparkContext.broadcast(ranks), _identity(ranks)  # one vocabulary

    def work() -> Callable[[pa.Array], list[list]]:
        pack = _packer(identity, shared.value, pattern)
        return lambda texts: [pack(texts)]

    return _add(docs, quoted(text_col).cast("string"), text_col, {"ids": T.BinaryType()}, work)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text") -> DataFrame:
    """:func:`encode` and :func:`decode` by one worker: columns of ``docs`` without the text, plus ``ids`` and ``decoded``."""
    shared, identity = docs.sparkSession.sparkContext.broadcast(ranks), _identity(ranks)

    def work() -> Callable[[pa.Array], list[list]]:
        pack, vocabulary = _packer(identity, shared.value, pattern), _vocabulary(identity, shared.value)

        def both(texts: pa.Array) -> list[list]:
            packed = pack(texts)
            return [packed, list(map(vocabulary.text, packed))]

        return both

    return _add(docs, quoted(text_col).cast("string"), text_col, {"ids": T.BinaryType(), "decoded": T.StringType()}, work)


class Utf8Machine:
    """Incremental UTF-8 decoder: bytes in, whole characters out."""

    def __init__(self) -> None:
        self.held, self.needs, self.low, self.high = bytearray(), 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        """Characters that are complete after ``data``; impossible bytes become U+FFFD each maximal piece."""
        out = []
        for byte in data:
            if self.needs:
                if self.low <= byte <= self.high:
                    self.held.append(byte)
                    self.needs, self.low, self.high = self.needs - 1, 0x80, 0xBF
                    if not self.needs:
                        out.append(self.held.decode())
                        self.held.clear()
                    continue
                out.append(self.end())
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self.held.append(byte)
                self.needs = 1 + (byte >= 0xE0) + (byte >= 0xF0)
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        """What an unfinished character becomes at the end."""
        cut, self.needs, self.low, self.high = bool(self.held), 0, 0x80, 0xBF
        self.held.clear()
        return "�" * cut


class Vocabulary:
    """Bytes of each id, and which of them hold whole characters."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.texts: list[str | None] = [None] * len(self.tokens)
        for rank, token in enumerate(self.tokens):
            try:
                self.texts[rank] = token.decode() if token is not None else None
            except UnicodeDecodeError:
                pass
        self.whole = np.array([t is not None for t in self.texts])

    def stream(self, ids: np.ndarray) -> Iterator[str]:
        """Text of the ids, piece by piece."""
        machine, done = Utf8Machine(), 0
        for at in np.flatnonzero(~self.whole[ids]).tolist():
            if at > done:
                yield machine.end()
                yield "".join(map(self.texts.__getitem__, ids[done:at].tolist()))
            token = self.tokens[ids[at]]
            if token is None:
                raise ValueError(f"id {ids[at]} is not in the vocabulary")
            yield machine.feed(token)
            done = at + 1
        yield machine.end()
        yield "".join(map(self.texts.__getitem__, ids[done:].tolist()))


    def text(self, packed: bytes | None) -> str:
        """Text of packed ids."""
        return "".join(self.stream(np.frombuffer(packed or b"", "<u4")))


def _vocabulary(identity: tuple, ranks: dict[bytes, int]) -> Vocabulary:
    key = ("vocabulary", identity)
    if key not in _built:
        _built[key] = Vocabulary(ranks)
    return _built[key]


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """Columns of ``encoded`` plus ``decoded`` (string)."""
    shared, identity = encoded.sparkSession.sparkContext.broadcast(ranks), _identity(ranks)

    def work() -> Callable[[pa.Array], list[list]]:
        vocabulary = _vocabulary(identity, shared.value)
        return lambda ids: [[vocabulary.text(i.as_py()) for i in ids]]

    return _add(encoded, quoted(ids_col), "decoded", {"decoded": T.StringType()}, work)


def token_count(ids: str = "ids"):
    """Number of ids in a packed column."""
    return (F.octet_length(ids) / 4).cast("long")
