"""Steps whose cost at size came from how often, or how, they are run."""

from pyspark.sql import functions as F

from edugauge.functions import title_case
from edugauge.session import compile_wide_projections
from workloads import layers, standin

SF = "/root/testdata/sf0.001"
LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_wide_projections_are_compiled_in_a_session_with_spark_defaults(spark):
    own = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        standin.silver_frame(spark, SF, "TS_ALUNO")
        assert int(spark.conf.get(LIMIT)) == 8000
        spark.conf.set(LIMIT, "20000")  # chosen by the cluster
        compile_wide_projections(spark)
        assert int(spark.conf.get(LIMIT)) == 20000
    finally:
        spark.conf.set(LIMIT, own)


def test_titles_with_numbers_and_marks(spark):
    names = {"customer#000000123": "Customer#000000123", "3a b4c--d": "3A B4C--D", "olho-d'água 2º x1": "Olho-D'Água 2º X1", "a1b": "A1B", "12": "12", "a.": "A."}
    rows = spark.createDataFrame([(k,) for k in names], "c string").select("c", title_case("c").alias("t"), title_case(F.upper("c")).alias("u")).collect()
    assert {r["c"]: r["t"] for r in rows} == names
    assert {r["c"]: r["u"] for r in rows} == names


def test_goals_read_twice_are_stored(spark):
    goals, _ = layers._meta_and_external(spark, SF)
    assert goals.inputFiles() and all("/stored-" in f for f in goals.inputFiles())


def test_pupil_fact_joins_a_stored_state_table(spark):
    files = standin.gold_frame(spark, SF, "FT_MACHINE_LEARNING").inputFiles()
    assert any("/stored-" in f for f in files)


def test_pupils_are_dealt_before_they_are_grouped_by_town(spark, monkeypatch):
    monkeypatch.setattr(standin, "GROUP_ROWS", 500, raising=False)
    towns = standin.relation(spark, SF, "municipio_groups")
    placed = towns.select("ck", "ano", F.spark_partition_id().alias("part")).collect()
    parts = {}
    for r in placed:
        parts.setdefault((r["ck"], r["ano"]), set()).add(r["part"])
    # as many tasks as the rows ask for, not as the session has shuffle partitions; a town's year is in one of them
    assert len({r["part"] for r in placed}) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(len(p) == 1 for p in parts.values())
    plain = spark.sql(standin.ctes(standin.SPARK, "SELECT * FROM municipio_groups"))
    assert sorted(towns.collect()) == sorted(plain.collect())
