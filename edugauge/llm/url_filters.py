"""Temporal URL list join: dated list entries become validity intervals, captures are judged as of their fetch time.

Entries are ``(list_name, blocks, key, action, day)``: on ``day`` the key is put on the list (``add``) or taken off
(``remove``). A key is a host name, which also covers its subdomains (the last label alone a whole top-level domain), or
a host followed by a directory path, which covers everything below it on that host. The case of a host does not matter, that of a path does;
a path's closing slash may be left out. Per list and key the events become intervals ``[valid_from, valid_to)``.

Captures are not joined with intervals one by one. The distinct sites (host and directory) of all captures are matched
with the intervals of every host suffix and path prefix, which gives each site a short sorted list of steps in time;
a capture then takes the last step at or before its fetch day: one row in, one row out, whatever the number of entries.
Among entries active at once the longest key decides; equally long ones block if any of them blocks, and the smallest
list name is reported.

Defined cases: a null or malformed URL has no site and stays, as does a capture without a fetch time. Events without list, key, action or
day are ignored; a list without ``blocks`` allows. Several events of one list, key and day count as one, a removal if any of them removes. Repeated
captures are all judged. Other columns of the captures are returned as they are, but for those of the result's names. Empty tables give empty
results, and without entries nothing is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edugauge.llm.common import broadcast_if_small, keep_columns, quoted, store

#: Host and path of an absolute URL: scheme, optional user part, host, optional port, path without query and fragment.
URL = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)"
RESULT = ("blocked", "matched_key", "list_name", "valid_from")


def host_of(url: Column) -> Column:
    """Lower-case host without a closing dot, null where there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, URL, 1)), r"\.$", "")
    return F.when(host != "", host)


def directory_of(url: Column) -> Column:
    """Path up to its last slash, ``/`` where there is no path."""
    path = F.regexp_extract(F.regexp_extract(url, URL, 2), r"^(/(?:[^/]*/)*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def covering_keys(host: Column, directory: Column, widest: bool = True) -> Column:
    """Every key that covers a site: its host suffixes, and the host with each directory above. Only with ``widest``
    the last label of a longer host, and the host's root directory, are among them."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n if widest else F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    steps = F.split(F.btrim(directory, F.lit("/")), "/", -1)
    depth = F.when(directory == "/", F.lit(0)).otherwise(F.size(steps))
    paths = F.transform(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/"), F.lit("/")))
    if widest:
        suffixes = F.concat(suffixes, F.array(F.concat(host, F.lit("/"))))
    return F.array_distinct(F.when(depth > 0, F.concat(suffixes, paths)).otherwise(suffixes))


def entry_key(key: Column) -> Column:
    """A listed key as ``covering_keys`` writes it: its host in lower case, its path, if any, closed by a slash."""
    host, path = F.lower(F.substring_index(key, "/", 1)), F.regexp_extract(key, "^[^/]*(/.*)?$", 1)
    return F.concat(host, path, F.when((path == "") | path.endswith("/"), F.lit("")).otherwise(F.lit("/")))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals ``list_name, blocks, key, valid_from, valid_to``; an open end is null."""
    dated = entries.select("list_name", "blocks", entry_key(F.col("key")).alias("key"), "action", F.col("day").cast("date").alias("day"))
    dated = dated.dropna(subset=["list_name", "key", "action", "day"])
    daily = dated.groupBy("list_name", "key", "day").agg(F.max(F.coalesce("blocks", F.lit(False))).alias("blocks"), (F.max((F.col("action") == "remove").cast("int")) == 0).alias("on"))
    by = Window.partitionBy("list_name", "key").orderBy("day")
    changes = daily.withColumn("before", F.lag("on").over(by)).filter(F.col("on") != F.coalesce("before", F.lit(False)))
    ended = changes.withColumn("valid_to", F.lead("day").over(by)).filter("on")
    return ended.select("list_name", "blocks", "key", F.col("day").alias("valid_from"), "valid_to")


def _timeline(sites: DataFrame, valid: DataFrame) -> DataFrame:
    """Per site its steps ``(day, blocked, matched_key, list_name, valid_from)`` in time order."""
    keyed = sites.select("site", F.explode("keys").alias("key"))
    active = keyed.join(valid, "key")
    days = active.select("site", F.explode(F.array("valid_from", "valid_to")).alias("day")).filter("day is not null").distinct()
    at = days.join(active, "site").filter("valid_from <= day and (valid_to is null or day < valid_to)")
    rank = F.struct(F.length("key").alias("long"), F.col("blocks"), F.col("key"))
    best = at.groupBy("site", "day").agg(F.max(rank).alias("best"))
    named = at.join(best, ["site", "day"]).filter("key = best.key and blocks = best.blocks")
    named = named.groupBy("site", "day").agg(F.first("best").alias("best"), F.min(F.struct("list_name", "valid_from")).alias("entry"))
    steps = days.join(named, ["site", "day"], "left").select(
        "site", F.struct("day", F.coalesce("best.blocks", F.lit(False)).alias("blocked"), F.col("best.key").alias("matched_key"), F.col("entry.list_name").alias("list_name"), F.col("entry.valid_from").alias("valid_from")).alias("step")
    )
    return steps.groupBy("site").agg(F.sort_array(F.collect_list("step")).alias("steps"))


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetch_day") -> DataFrame:
    """``captures`` with ``blocked, matched_key, list_name, valid_from`` as of the fetch day."""
    host, directory = host_of(quoted(url_col)), directory_of(quoted(url_col))
    site = F.concat(host, directory)
    sites = captures.select(site.alias("site"), host.alias("host"), directory.alias("directory")).filter("host is not null").distinct()
    sites = sites.select("site", covering_keys(F.col("host"), F.col("directory")).alias("keys"))
    steps = store(_timeline(sites, intervals(entries)), "site_steps")
    day = quoted(time_col).cast("date")
    joined = captures.withColumn("__llm_site", site).join(broadcast_if_small(steps.withColumnsRenamed({"site": "__llm_site", "steps": "__llm_steps"}), 2000), "__llm_site", "left")
    last = F.element_at(F.filter("__llm_steps", lambda s: s["day"] <= day), -1)
    judged = joined.withColumn("__llm_step", F.when(F.size(F.filter("__llm_steps", lambda s: s["day"] <= day)) > 0, last))
    step = lambda name: F.col(f"__llm_step.{name}")
    return judged.select(*keep_columns(captures, *RESULT), F.coalesce(step("blocked"), F.lit(False)).alias("blocked"), *(step(n).alias(n) for n in RESULT[1:]))
