"""Tables replaced part by part: refresh by key against a full rebuild, killed runs, two writers."""
import os

import pytest
from pyspark.sql import functions as F

from clinspark.operators import silver
from clinspark.operators.windows import keep_last
from clinspark.sources import testdata as T
from clinspark.sources.versions import PART, Versions, merge_by_key

SCHEMA = "k string, at long, v string"


def _rows(df):
    return sorted(map(str, df.collect()))


def _extracts(spark):
    """A hot key, keys only in one extract, NULL and empty keys, equal rows in two extracts."""
    first = [("hot", i, f"a{i}") for i in range(300)] + [(f"k{i}", 1, "old") for i in range(200)] + [(None, 1, "n"), ("", 1, "e")]
    second = [("hot", 7, "late"), ("hot", 900, "new")] + [(f"k{i}", 2, "new") for i in range(0, 200, 9)] + [(None, 0, "older"), ("", 2, "e2")]
    third = [(f"x{i}", 1, None) for i in range(50)] + second[:3]
    return [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (first, second, third, [])]


def test_refresh_equals_rebuild(spark, tmp_dir):
    path, seen = os.path.join(tmp_dir, "t"), None
    for extract in _extracts(spark):
        seen = extract if seen is None else seen.unionByName(extract)
        got = merge_by_key(spark, extract, path, ["k"], ["at"], 8)
        assert _rows(got) == _rows(keep_last(seen, ["k"], ["at"]))
    again = merge_by_key(spark, _extracts(spark)[1], path, ["k"], ["at"], 8)
    assert _rows(again) == _rows(keep_last(seen, ["k"], ["at"]))


def test_refresh_of_patients_equals_the_silver_table(spark, tmp_dir):
    raw = T.bronze(spark, "/root/testdata/sf0.001", "patients")
    day = F.pmod(F.xxhash64("patient_id", "extracted_at"), F.lit(3))
    path = os.path.join(tmp_dir, "patients")
    for i in range(3):
        got = merge_by_key(spark, raw.where(day == i), path, ["mrn_digest"], ["extracted_at", "patient_id"], 4)
    assert _rows(silver.transform_patients(got)) == _rows(silver.transform_patients(raw))


def test_only_parts_with_new_keys_are_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    merge_by_key(spark, _extracts(spark)[0], path, ["k"], ["at"], 16)
    table = Versions(spark, path, 16)
    before = table._manifest(1)["live"]
    merge_by_key(spark, spark.createDataFrame([("k3", 5, "x")], SCHEMA), path, ["k"], ["at"], 16)
    after = table._manifest(2)["live"]
    assert table.current() == 2 and sum(before[p] != after[p] for p in after) == 1


def test_killed_run_leaves_the_table(spark, tmp_dir):
    """A write that fails, and one that ends before its commit, change nothing; the next run is whole."""
    path = os.path.join(tmp_dir, "t")
    first, second = _extracts(spark)[:2]
    want = _rows(merge_by_key(spark, first, path, ["k"], ["at"], 4))
    broken = second.withColumn("v", F.when(F.col("at") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        merge_by_key(spark, broken, path, ["k"], ["at"], 4)
    table = Versions(spark, path, 4)
    assert _rows(table.read(SCHEMA)) == want
    second.withColumn(PART, F.lit(0)).write.partitionBy(PART).parquet(f"{path}/data-0000000002-killed")
    open(f"{path}/_commits/_ab12", "w").write('{"live": {"0": "data-0000000002-kil')  # a commit cut short
    assert table.current() == 1 and _rows(table.read(SCHEMA)) == want
    got = merge_by_key(spark, second, path, ["k"], ["at"], 4)
    assert _rows(got) == _rows(keep_last(first.unionByName(second), ["k"], ["at"]))


def test_second_writer_of_a_version_fails(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    table = Versions(spark, path, 4)
    rows = spark.createDataFrame([("a", 1, "x")], SCHEMA).withColumn(PART, F.lit(0))
    table.replace(rows, 1, [0])
    with pytest.raises(RuntimeError, match="another writer"):
        table.replace(rows.withColumn("v", F.lit("y")), 1, [0])
    assert _rows(table.read(SCHEMA)) == ["Row(k='a', at=1, v='x')"]


def test_readers_of_a_version_keep_it(spark, tmp_dir):
    """A frame read before a write gives the old rows after it; parts can be emptied; older versions go."""
    path = os.path.join(tmp_dir, "t")
    table = Versions(spark, path, 2)
    for v in range(1, 5):
        before = table.read(SCHEMA)
        rows = spark.createDataFrame([(f"k{v}", v, "x")], SCHEMA).withColumn(PART, F.lit(v % 2))
        table.replace(rows, v, [v % 2], info={"n": v})
        assert len(before.collect()) == min(v - 1, 2)
    table.prune()
    assert table.info() == {"n": 4} and table.read(SCHEMA, 3).count() == 2
    table.replace(rows.where("false"), 5, [0, 1])
    assert table.read(SCHEMA).count() == 0 and table.current() == 5
