import pytest
from pyspark.sql import functions as F

from edugauge import sources
from edugauge.operators.windows import dedupe_first


def write(path, text, encoding="iso-8859-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_yearly_scan_aligns_drifting_columns(spark, tmp_path):
    write(tmp_path / "2023" / "T.csv", "A;B;EXTRA\n1;são;9\n")
    write(tmp_path / "2025" / "T.csv", "B;A;C\nx;2;3\n")
    df = sources.read_yearly(spark, str(tmp_path), "T.csv", [2023, 2024, 2025], ["A", "B", "C", "D"])
    assert sorted(df.columns) == ["A", "B", "C", "D"]
    assert {tuple(r) for r in df.select("A", "B", "C", "D").collect()} == {("1", "são", None, None), ("2", "x", "3", None)}


def test_yearly_scan_fails_only_without_any_year(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_yearly(spark, str(tmp_path), "T.csv", [2023])


def test_first_row_in_file_order_wins(spark, tmp_path):
    lines = "".join(f"{i % 7};{i}\n" for i in range(5000))
    write(tmp_path / "2023" / "T.csv", "K;V\n" + lines)
    df = sources.read_yearly(spark, str(tmp_path), "T.csv", [2023], ingest_order=True)
    first = dedupe_first(df.repartition(4), ["K"], sources.INGEST_ORDER)
    assert {(r["K"], r["V"]) for r in first.collect()} == {(str(i), str(i)) for i in range(7)}


def test_sheet_takes_header_from_second_row_and_drops_notes(spark, tmp_path):
    write(tmp_path / "s.csv", "Resultados,,\nANO,CO,NOME\n2024,11,são\n2025,12,b\n,,nota\n", "utf-8")
    df = sources.read_sheet(spark, str(tmp_path / "s.csv"), "CO")
    assert {tuple(r) for r in df.collect()} == {("2024", "11", "são"), ("2025", "12", "b")}


def test_declared_csv_and_report(spark, tmp_path):
    write(tmp_path / "c.csv", "B,A\n1.5,7\n", "utf-8")
    assert [tuple(r) for r in sources.read_csv(spark, str(tmp_path / "c.csv"), "A int, B double").collect()] == [(7, 1.5)]
    path = sources.write_report(spark.range(3), str(tmp_path / "report"))
    assert sources.read_report(spark, path, "id bigint").count() == 3


def test_shards_respect_the_byte_bound_and_keep_rows(spark, tmp_path):
    df = spark.range(400).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("ç"), (F.col("id") % 30).cast("int")).alias("t"))
    path = sources.write_sharded(df.coalesce(1), str(tmp_path / "shards"), max_bytes=1500)
    parts = sorted((tmp_path / "shards").glob("part-*"))
    assert len(parts) > 3 and all(p.stat().st_size <= 1500 for p in parts)
    assert all(p.read_bytes().startswith(b"k;t\n") for p in parts)
    back = sources.read_sharded(spark, path)
    assert {(r["k"], r["t"] or "") for r in back.collect()} == {(r["k"], r["t"]) for r in df.collect()}


def test_shards_by_rows(spark, tmp_path):
    sources.write_sharded(spark.range(25).coalesce(1), str(tmp_path / "s"), max_rows=10)
    assert len(list((tmp_path / "s").glob("part-*"))) == 3


def test_layer_table_overwrite_and_partition(spark, tmp_path):
    df = spark.createDataFrame([(2023, 1), (2024, 2)], "y int, v int")
    sources.write_table(df, str(tmp_path), "T", ["y"])
    sources.write_table(df, str(tmp_path), "T", ["y"])
    stored = sources.read_table(spark, str(tmp_path), "T", ["v", "y"])
    assert sorted(map(tuple, stored.collect())) == [(1, 2023), (2, 2024)]
    plan = stored.filter("y = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan


def test_counts_of_a_stored_table(spark, tmp_path):
    sources.write_table(spark.createDataFrame([(1,), (0,), (None,)], "t int"), str(tmp_path), "T")
    stored = sources.read_table(spark, str(tmp_path), "T")
    assert sources.stored_counts(stored, "t") == {"rows": 3, "target_1": 1, "target_0": 1, "target_null": 1}


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(100).repartition(16)
    assert sources.spread(wide) is wide
    assert sources.spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == 4
