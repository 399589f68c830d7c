"""Staged tables in buckets of the encounter: the same models as over plain tables, joined without an exchange."""
import os

from pyspark.sql import functions as F

from clinspark.operators import gold, staged
from clinspark.plans.catalog import Tables
from clinspark.sources import buckets


SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


def sources(spark):
    t = Tables(spark, SF)
    return [t.silver(n) for n in ("patients", "encounters", "labs", "billing")]


def both_equal(got, patients, encounters, labs, billing):
    mart = gold.patient_encounter_mart(patients, encounters, labs, billing)
    assert set(staged.patient_encounter_mart(got).columns) == set(mart.columns)
    rounded = lambda df: df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})
    assert rows(rounded(staged.patient_encounter_mart(got))) == rows(rounded(mart))
    model = gold.int_patient_encounters(gold.stg_patients(patients), gold.stg_encounters(encounters), labs, billing)
    assert staged.int_patient_encounters(got).schema.simpleString() == model.schema.simpleString()
    assert rows(rounded(staged.int_patient_encounters(got))) == rows(rounded(model))


def test_models_equal_those_over_plain_tables(spark, tmp_dir):
    given = sources(spark)
    both_equal(staged.stage(*given, tmp_dir, 8), *given)


def test_no_exchange_of_facts(spark, tmp_dir):
    """Neither model has an exchange at all, also where nothing is small enough to broadcast."""
    got = staged.stage(*sources(spark), tmp_dir, 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for model in (staged.patient_encounter_mart(got), staged.int_patient_encounters(got)):
            p = plan(model)
            assert "Exchange" not in p and p.count("SortMergeJoin") == 2 and "Bucketed: true" in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_encounter_holds_a_third(spark, tmp_dir):
    """A third of all labs and claims at one encounter, a third of all rows without one, encounters without an id."""
    patients, encounters, labs, billing = sources(spark)
    hot = F.pmod(F.xxhash64(F.col("lab_result_id")), F.lit(3))
    labs = labs.withColumn("encounter_id", F.when(hot == 0, F.lit(7)).when(hot == 1, F.lit(None)).otherwise(F.col("encounter_id")))
    hot = F.pmod(F.xxhash64(F.col("claim_id")), F.lit(3))
    billing = billing.withColumn("encounter_id", F.when(hot == 0, F.lit(7)).when(hot == 1, F.lit(None)).otherwise(F.col("encounter_id")))
    encounters = encounters.withColumn("encounter_id", F.when(F.col("encounter_id") % 3 == 0, None).otherwise(F.col("encounter_id")))
    got = staged.stage(patients, encounters, labs, billing, tmp_dir, 8)
    both_equal(got, patients, encounters, labs, billing)
    # what a bucket holds follows its encounters, not their labs
    held = [r["count"] for r in got.labs.groupBy(F.spark_partition_id()).count().collect()]
    assert got.labs.where("encounter_id = 7").count() == 1 and max(held) < 2 * sum(held) / len(held)
    assert got.encounters.where("encounter_id IS NULL").count() == 0 and got.unkeyed.count() > 0
    # map-side sums come before the exchange that deals the buckets
    p = plan(staged.lab_totals(labs))
    assert p.index("Exchange hashpartitioning") < p.index("partial_count")


def test_empty_tables(spark, tmp_dir):
    """Facts without rows, or with none that has an encounter, and no encounters."""
    patients, encounters, labs, billing = sources(spark)
    none = lambda df: df.where("false")
    unplaced = labs.withColumn("encounter_id", F.lit(None).cast("long"))
    for i, given in enumerate([(patients, encounters, none(labs), none(billing)), (patients, encounters, unplaced, billing),
                               (none(patients), none(encounters), labs, billing), tuple(map(none, (patients, encounters, labs, billing)))]):
        both_equal(staged.stage(*given, os.path.join(tmp_dir, str(i)), 4), *given)


def test_buckets_need_no_catalog(spark, tmp_dir):
    """The layout lies beside the files: any session joins without an exchange, and no entry stays in the catalog."""
    df = spark.range(1000).withColumns({"key": F.col("id") % 50, "a b`c": F.col("id").cast("string")})
    want = rows(df)
    assert rows(buckets.write(df, tmp_dir, "key", 4, {"empty": False})) == want
    again = buckets.read(spark, tmp_dir)
    assert rows(again) == want and "Exchange" not in plan(again.groupBy("key").count())
    assert buckets.info_of(spark, tmp_dir) == {"empty": False}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("clinspark_bucketed")]
    # a new write replaces the table for readers, with a layout of its own; who has the former reads on
    buckets.write(df.where("id < 10"), tmp_dir, "id", 3)
    assert buckets.read(spark, tmp_dir).count() == 10 and again.count() == 1000
