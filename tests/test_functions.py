import math

import pytest
from pyspark.sql import functions as F

from edugauge import functions as fn
from edugauge.functions import dictionaries as d


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_strip_and_title_follow_any_space_and_any_non_letter(spark):
    rows = [("OLHO-D'ÁGUA DO BORGES",), ("  são joão del-rei ",), ("a1b\tc",), ("",), (None,)]
    got = values(spark, rows, "s string", fn.title_case(fn.strip("s")))
    assert got == ["Olho-D'Água Do Borges", "São João Del-Rei", "A1B\tC", "", None]


def test_title_matches_python_on_plain_text(spark):
    texts = ["d'água", "são-TOMÉ das letras", "x  y", "3 corações", "ÉVORA/beja", "um(dois)três", "é"]
    assert values(spark, [(t,) for t in texts], "s string", fn.title_case("s")) == [t.title() for t in texts]


def test_keys(spark):
    df = spark.createDataFrame([(2023, 1200013, 2, 3)], "a int, b int, c int, e int")
    row = df.select(fn.concat_key("a", "b"), fn.sha256_key("a", "b", "c", "e"), fn.zero_padded("c", 7), fn.zero_padded(F.lit(12345678), 7)).first()
    import hashlib

    assert row[0] == "2023|1200013"
    assert row[1] == hashlib.sha256(b"2023|1200013|2|3").hexdigest()
    assert row[2] == "0000002" and row[3] == "12345678"


def test_joined_label_is_null_with_a_null_side(spark):
    assert values(spark, [("A", None), ("A", "B")], "a string, b string", fn.joined_label("a", "b")) == [None, "A - B"]


def test_tolerant_casts(spark):
    rows = [("1.25",), (" 7 ",), ("x",), ("",), ("1d",), ("2F",), ("nan",), (None,), ("1e2",)]
    assert values(spark, rows, "s string", fn.tolerant_double("s")) == [1.25, 7.0, None, None, None, None, None, None, 100.0]
    assert values(spark, [("1.0",), ("x",)], "s string", fn.tolerant_int("s")) == [1, None]
    odd = [("0x1p3",), ("inf",), ("-Infinity",), (".5",), ("5.",), ("1_0",)]
    assert values(spark, odd, "s string", fn.tolerant_double("s")) == [None, float("inf"), float("-inf"), 0.5, 5.0, None]


@pytest.mark.parametrize("fraction", ["1.5", "-0.9", "inf", "1e30"])
def test_tolerant_int_refuses_what_is_no_integer(spark, fraction):
    with pytest.raises(Exception, match="not an integer"):
        values(spark, [(fraction,)], "s string", fn.tolerant_int("s"))


def test_sheet_int_reads_decimals_of_exports(spark):
    assert values(spark, [("12.0",), ("2304400.",), (" 7.00 ",), ("35",)], "s string", fn.sheet_int("s")) == [12, 2304400, 7, 35]
    for bad in ("12.5", "x", None):
        with pytest.raises(Exception, match="strict integer|CAST_INVALID_INPUT"):
            values(spark, [(bad,)], "s string", fn.sheet_int("s"))


@pytest.mark.parametrize("bad", ["x", None])
def test_strict_int_raises_on_bad_text_and_null(spark, bad):
    with pytest.raises(Exception):
        values(spark, [(bad,)], "s string", fn.strict_int("s"))
    assert values(spark, [("12",)], "s string", fn.strict_int("s")) == [12]


def test_nullable_int_lets_null_through_only(spark):
    assert values(spark, [("5",), (None,)], "s string", fn.nullable_int("s")) == [5, None]
    with pytest.raises(Exception):
        values(spark, [("5x",)], "s string", fn.nullable_int("s"))


def test_goal_cells(spark):
    rows = [("55.3",), ("-",), (" - ",), ("",), ("> 80",), (">80",), (None,)]
    assert values(spark, rows, "s string", fn.clean_goal("s")) == [55.3, None, None, None, 80.0, 80.0, None]


def test_rounding_is_half_even(spark):
    assert values(spark, [(0.125,), (0.375,), (-0.125,), (2.675,)], "x double", fn.round_half_even("x")) == [0.12, 0.38, -0.12, 2.68]


def test_bands_are_right_closed(spark):
    scores = [649.99, 649.995, 650.0, 699.99, 742.99, 742.995, 743.0, 799.99, 800.0, None]
    band = fn.right_closed_band("x", *d.SCORE_BANDS, null_label="Não avaliado")
    assert values(spark, [(s,) for s in scores], "x double", band) == [
        "< 650", "650-699", "650-699", "650-699", "700-742", "743-799", "743-799", "743-799", "800+", "Não avaliado",
    ]
    mean = fn.right_closed_band("x", *d.MEAN_BANDS)
    assert values(spark, [(None,), (700.0,)], "x double", mean) == [None, "700-742"]
    literacy = fn.right_closed_band("x", *d.LITERACY_BANDS)
    assert values(spark, [(39.99,), (40.0,), (59.99,), (79.99,), (80.0,)], "x double", literacy) == [
        "Muito Baixa", "Baixa", "Baixa", "Boa", "Excelente",
    ]


def test_levels_and_relative_labels(spark):
    level = fn.descending_label("x", d.LEVEL_THRESHOLDS, d.LEVEL_DEFAULT, d.LEVEL_DEFAULT)
    assert values(spark, [(80.0,), (79.99,), (40.0,), (39.9,), (None,)], "x double", level) == [
        "Nível 5", "Nível 4", "Nível 1", "Abaixo do Nível 1", "Abaixo do Nível 1",
    ]
    relative = fn.descending_label("x", d.RELATIVE_THRESHOLDS, d.RELATIVE_DEFAULT, None)
    assert values(spark, [(30.0,), (10.0,), (-10.0,), (-30.0,), (-30.1,), (None,)], "x double", relative) == [
        "Muito Acima", "Acima", "Na Média", "Abaixo", "Muito Abaixo", None,
    ]


def test_null_comparisons_count_as_no(spark):
    rows = [(None,), (1.0,), (-1.0,)]
    assert values(spark, rows, "x double", fn.yes_no(F.col("x") >= 0)) == ["Não", "Sim", "Não"]
    assert values(spark, rows, "x double", fn.flag01(F.col("x") >= 0)) == [0, 1, 0]


def test_lookup_and_fallback(spark):
    assert values(spark, [(2,), (3,), (None,)], "k int", fn.lookup(d.GRADE_NAMES, "k", F.col("k").cast("string"))) == [
        "2º Ano do Ensino Fundamental", "3", None,
    ]
    assert len(d.STATE_REGIONS) == 27 and set(d.STATE_REGIONS) == set(d.STATE_CODES)


def test_goal_of_year_picks_own_year(spark):
    pick = fn.pick_by_year("y", {2024: "a", 2025: "b"})
    assert values(spark, [(2023, 1.0, 2.0), (2024, 1.0, 2.0), (2025, 1.0, None)], "y int, a double, b double", pick) == [None, 1.0, None]


def test_shares_and_counts(spark):
    rows = [(1, 1, 2), (0, 0, 0)]
    assert values(spark, rows, "a int, b int, c int", fn.share_of_parts("a", ["a", "b", "c"])) == [25.0, None]
    assert values(spark, [(1, None), (None, None)], "a int, b int", fn.count_present(["a", "b"])) == [1, 0]
    assert values(spark, [(1, None), (None, None)], "a int, b int", fn.present_flag("a", "b")) == [1, 0]
    assert values(spark, [(1.0, 0.0), (1.0, 2.0)], "a double, b double", fn.safe_ratio("a", "b")) == [0.0, 0.5]


def test_profiles_and_indices(spark):
    levels = [f"n{i}" for i in range(9)]
    rows = [(10.0, 20.0, 5.0, 5.0, 10.0, 10.0, 10.0, 20.0, 10.0), (0.0,) * 4 + (50.0, 50.0, 0.0, 0.0, 0.0), (None,) * 9]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in levels)).coalesce(1).withColumns(fn.level_profiles(levels))
    low, dev = "PC_PERFIL_EXTREMA_DEFASAGEM", "PC_PERFIL_EM_DESENVOLVIMENTO"
    out = df.select(
        low, "PC_PERFIL_LIMITROFE",
        fn.polarisation_index("PC_TAXA_EXCELENCIA", low).alias("pol"),
        fn.structural_risk_index(levels, low, dev).alias("risk"),
    ).collect()
    assert tuple(out[0]) == (30.0, 30.0, 1.0, round((40 + 60 + 10 + 5) / 400, 4))
    assert out[1]["risk"] == 0.0 and out[1]["pol"] == 0.0
    assert all(v is None for v in out[2])
    assert not any(isinstance(v, float) and math.isnan(v) for r in out for v in r)
