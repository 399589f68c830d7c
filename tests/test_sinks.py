"""Sinks and readers: load, counts, upsert, conform, load formats, JSON/CSV/JDBC."""
import datetime as dt
import json
import os
import subprocess
import sys
import textwrap

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clinspark.schemas import TARGETS, conform
from clinspark.sources import buckets, readers, sinks


def test_load_returns_rows_and_skips_empty(spark, tmp_dir):
    df = spark.createDataFrame([("P001", "MRN001", True), ("P002", "MRN002", False)],
                               "patient_id string, mrn string, flag boolean")
    assert sinks.load(df, "raw_patients", "replace", path=os.path.join(tmp_dir, "p")) == 2
    assert sinks.load(df.where("false"), "raw_patients", "replace", path=os.path.join(tmp_dir, "q")) == 0
    back = spark.read.parquet(os.path.join(tmp_dir, "p"))
    assert dict(back.dtypes)["flag"] == "int"                    # booleans load as 0/1
    assert sinks.load(df, "raw_patients", "append", path=os.path.join(tmp_dir, "p")) == 2
    assert spark.read.parquet(os.path.join(tmp_dir, "p")).count() == 4


def test_loaded_files_have_no_dictionaries_and_the_same_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(2000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("P\u00e9 "), F.col("id") % 5)).alias("text"), "id")
    assert sinks.load(df, "t", "replace", path=path) == 2000
    assert sinks.load(df.where("id < 10"), "t", "append", path=path) == 10
    back = spark.read.parquet(path)
    assert back.exceptAll(df.unionAll(df.where("id < 10"))).isEmpty() and back.count() == 2010
    for part in (os.path.join(path, n) for n in os.listdir(path) if n.endswith(".parquet")):
        meta = pq.ParquetFile(part).metadata
        for group in (meta.row_group(g) for g in range(meta.num_row_groups)):
            columns = [group.column(c) for c in range(group.num_columns)]
            assert {(c.compression, c.has_dictionary_page) for c in columns} == {("ZSTD", False)}


def test_typed_files_give_back_every_value(spark, tmp_dir):
    """Values at the ends of their types, repeated, rising and absent ones, through the encodings of typed tables."""
    i = F.col("id")
    df = spark.range(30000).select(
        "id", F.when(i % 3 > 0, i * 7919 % 100003 - 50000).alias("long"), F.when(i % 2 == 0, F.lit(-2**63)).otherwise(F.lit(2**63 - 1)).alias("ends"),
        (i % 5).cast("int").alias("few"), F.lit(None).cast("string").alias("none"),
        F.when(i % 7 > 0, F.concat(F.lit("LAB-\u00e9-"), i, F.lit("-"), F.hash(i))).alias("text"),
        F.when(i % 11 == 0, F.lit("")).otherwise(F.repeat(F.lit("x"), (i % 40).cast("int"))).alias("blank"),
        F.when(i % 4 == 0, F.lit(float("nan"))).when(i % 4 == 1, F.lit(-0.0)).otherwise(i / 7).alias("real"),
        F.when(i % 5 > 0, i % 3 == 0).alias("flag"), F.date_add(F.lit("0001-01-01").cast("date"), i.cast("int")).alias("day"),
        F.timestamp_add("SECOND", i * 86399, F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")).alias("at"),
        F.timestamp_micros(i * 1234567).alias("instant"))
    sinks.load_measured(df, "t", "replace", os.path.join(tmp_dir, "a"), options=sinks.TYPED_FILES)
    sinks.load_measured(df, "t", "replace", os.path.join(tmp_dir, "b"), ["few"], ["id"], options=sinks.TYPED_FILES)
    back = [spark.read.parquet(os.path.join(tmp_dir, "a")), spark.read.parquet(os.path.join(tmp_dir, "b")),
            sinks.materialize(df, "t", "MARTS", path=tmp_dir), buckets.write(df, os.path.join(tmp_dir, "c"), "long", 5)]
    want = df.selectExpr("id AS _id", "struct(*) AS _want")
    for got in back:
        got = got.select(*df.columns)
        assert got.count() == 30000
        # row by row, with a NULL equal to a NULL
        assert got.select("id", F.struct("*").alias("_got")).join(want, F.col("id") == F.col("_id")).where(F.col("_got").eqNullSafe(F.col("_want"))).count() == 30000
    meta = pq.ParquetFile(next(os.path.join(tmp_dir, "a", n) for n in os.listdir(os.path.join(tmp_dir, "a")) if n.endswith(".parquet"))).metadata
    found = {c.path_in_schema: c for c in (meta.row_group(0).column(k) for k in range(meta.num_columns))}
    assert {c.compression for c in found.values()} == {"ZSTD"}
    assert "DELTA_BYTE_ARRAY" in found["text"].encodings and "DELTA_BINARY_PACKED" in found["id"].encodings


def test_table_counts(spark):
    a = spark.range(3)
    b = spark.range(0)
    got = {r.table_name: r.row_count for r in sinks.table_counts({"a": a, "b": b}).collect()}
    assert got == {"a": 3, "b": 0}


def test_replace_with_no_rows_leaves_an_empty_table(spark, tmp_dir):
    df = spark.createDataFrame([(1, "2026-01")], "id long, month string")
    path = os.path.join(tmp_dir, "t")
    for partition in (None, ["month"]):
        assert sinks.load(df, "t", "replace", path=path, as_text=False, partition_by=partition) == 1
        assert sinks.load(df.where("id < 0"), "t", "replace", path=path, as_text=False, partition_by=partition) == 0
        back = spark.read.parquet(path)
        assert back.count() == 0 and set(back.columns) == {"id", "month"}


def test_upsert_touches_no_other_key(spark, tmp_dir):
    """Rows of other runs stay as they are, even where their files cannot be read."""
    path, s = os.path.join(tmp_dir, "runs"), TARGETS["pipeline_runs"]
    row = lambda i, status: spark.createDataFrame([(i, "t0", "t1", status, 5, 0.9, 1.0, "{}")], s)
    sinks.upsert_by_key(spark, row("r1", "SUCCESS"), path, ["run_id"])
    broken = os.path.join(path, "_run_id=%3Dold")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    table = sinks.upsert_by_key(spark, row("r2", "SUCCESS").unionByName(row("r2", "RUNNING")), path, ["run_id"])
    assert os.path.exists(os.path.join(broken, "part-0.parquet"))
    with pytest.raises(Exception, match="(?i)parquet"):
        table.collect()
    good = spark.read.schema(s).parquet(*[os.path.join(path, f"_run_id=%3Dr{i}") for i in (1, 2)]).collect()
    assert sorted((r.run_id, r.status) for r in good) == [("r1", "SUCCESS"), ("r2", "SUCCESS")]


def test_null_and_empty_run_ids_are_apart(spark, tmp_dir):
    path, s = os.path.join(tmp_dir, "runs"), TARGETS["pipeline_runs"]
    row = lambda i, status: spark.createDataFrame([(i, "t0", "t1", status, 5, 0.9, 1.0, "{}")], s)
    for i, status in ((None, "A"), ("", "B"), ("null", "C"), (None, "D"), ("a/b=c", "E")):
        table = sinks.upsert_by_key(spark, row(i, status), path, ["run_id"])
    assert sorted((str(r.run_id), r.status) for r in table.collect()) == [("", "B"), ("None", "D"), ("a/b=c", "E"), ("null", "C")]


def test_measures_of_a_write_count_a_retried_task_once(tmp_dir):
    """Every task of the write fails at its first try, after it has given its rows."""
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from pyspark import TaskContext
        from pyspark.sql import functions as F
        from clinspark.session import get_session
        from clinspark.sources import sinks
        spark = get_session("local[2,4]", extra={{"spark.ui.enabled": "false"}})

        def once(batches):
            for b in batches:
                yield b
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("first try")

        df = spark.range(1000, numPartitions=4).mapInArrow(once, "id long")
        got = sinks.load_measured(df, "t", "replace", {os.path.join(tmp_dir, "t")!r}, metrics={{"odd": F.count_if(F.col("id") % 2 == 1)}})
        assert got == {{"rows": 1000, "odd": 500}}, got
        assert spark.read.parquet({os.path.join(tmp_dir, "t")!r}).count() == 1000
    """)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=240)


def test_table_source_and_materialized_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    spark.sql("DROP TABLE IF EXISTS clinspark_test_mart")
    made = sinks.materialize(df, "clinspark_test_mart", "MARTS")
    assert made.count() == 2
    back = readers.read_source(spark, {"format": "table", "table": "clinspark_test_mart", "schema": "id long"})
    assert sorted(r.id for r in back.collect()) == [1, 2] and dict(back.dtypes) == {"id": "bigint"}
    spark.sql("DROP TABLE clinspark_test_mart")


def test_upsert_by_key(spark, tmp_dir):
    path = os.path.join(tmp_dir, "runs")
    s = TARGETS["pipeline_runs"]
    r1 = spark.createDataFrame([("r1", "t0", "t1", "RUNNING", 5, 0.9, 1.0, "{}")], s)
    sinks.upsert_by_key(spark, r1, path, ["run_id"])
    r2 = spark.createDataFrame([("r1", "t0", "t2", "SUCCESS", 5, 0.99, 2.0, "{}"),
                                ("r2", "t3", "t4", "SUCCESS", 6, 1.0, 1.0, "{}")], s)
    out = {r.run_id: r.status for r in sinks.upsert_by_key(spark, r2, path, ["run_id"]).collect()}
    assert out == {"r1": "SUCCESS", "r2": "SUCCESS"}


def test_conform_and_load_format(spark):
    df = spark.createDataFrame([(1, True, dt.datetime(2026, 1, 1, 5), None, "extra")],
                               "lab_result_id long, is_critical boolean, collected_datetime timestamp_ntz, "
                               "abnormal_flag string, other string")
    c = conform(df, TARGETS["raw_labs"])
    assert c.columns == [f.name for f in TARGETS["raw_labs"].fields]
    r = c.first()
    assert r.lab_result_id == "1" and r.is_critical == 1 and r.collected_datetime == "2026-01-01 05:00:00"
    assert r.test_name is None
    blank = sinks.load_format(df, blank=True).first()
    assert blank.abnormal_flag == "" and blank.is_critical == 1


def test_json_report(spark, tmp_dir):
    sinks.write_json_report(spark.createDataFrame([("c", True)], "check string, passed boolean"),
                            os.path.join(tmp_dir, "rep"))
    files = [f for f in os.listdir(os.path.join(tmp_dir, "rep")) if f.endswith(".json")]
    assert json.loads(open(os.path.join(tmp_dir, "rep", files[0])).readline()) == {"check": "c", "passed": True}


def test_readers_json_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ehr.json")
    with open(p, "w") as f:
        f.write(json.dumps({"entry": [{"id": "1", "v": 1.5}, {"id": "2", "v": 2.0}]}) + "\n")
        f.write("{not json\n")
    df = readers.read_source(spark, {"format": "json", "path": p, "explode": "entry",
                                     "schema": "entry array<struct<id string, v double>>"})
    rows = df.collect()
    assert sorted(r.id for r in rows if r.id) == ["1", "2"]
    # the malformed line is kept and can be counted
    assert [r._corrupt_record for r in rows if r.id is None] == ["{not json"]
    c = os.path.join(tmp_dir, "lab.csv")
    with open(c, "w") as f:
        f.write("id,value,at\nA,1.5,2026-01-01T10:00:00\nB,oops,2026-01-02T11:00:00\n")
    df = readers.read_source(spark, {"format": "csv", "path": c, "schema": "id string, value double, at timestamp_ntz"})
    rows = {r.id: r for r in df.collect()}
    assert rows["A"].value == 1.5 and rows["B"].value is None and rows["A"].at == dt.datetime(2026, 1, 1, 10)


def test_reader_jdbc_embedded_derby(spark):
    url = "jdbc:derby:memory:clinspark_test;create=true"
    src = spark.range(100).select(F.col("id").alias("claim_no"), (F.col("id") * 1.5).alias("charge"))
    src.write.format("jdbc").option("url", url).option("dbtable", "claims").option(
        "driver", "org.apache.derby.jdbc.EmbeddedDriver").mode("overwrite").save()
    df = readers.read_source(spark, {"format": "jdbc", "url": url, "table": "claims",
                                     "driver": "org.apache.derby.jdbc.EmbeddedDriver",
                                     "partition_column": "claim_no", "lower_bound": 0, "upper_bound": 100,
                                     "num_partitions": 4, "schema": "claim_no long, charge double"})
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 100 and df.agg(F.sum("charge")).first()[0] == 1.5 * 4950
