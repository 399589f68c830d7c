"""Plan properties: no Python UDFs, pushdown, pruning, anti joins, partial aggregation."""
import pytest

from clinspark.plans import registry

Q = registry.queries()
SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q))
def test_no_python_udf(spark, name):
    p = plan(Q[name](spark, SF))
    for op in ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]:
        assert op not in p, (name, op)


def test_filter_pushed_to_scan(spark):
    p = plan(Q["raw_patients"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_acctbal), LessThan(c_acctbal,0.0)]" in p


def test_columns_pruned_at_scan(spark):
    p = plan(Q["labs_agg"](spark, SF))
    assert "l_extendedprice" not in p and "l_returnflag" not in p   # only lab columns are read


def test_orphans_use_anti_join_on_preaggregated_keys(spark):
    p = plan(Q["orphan_billing_patients"](spark, SF))
    assert "LeftAnti" in p and "partial_count" in p


def test_census_uses_fixed_width_aggregation(spark):
    """No Expand over the metrics and no object-buffer (percentile) aggregate:
    the median comes from per-value counts and a bounded window."""
    p = plan(Q["mart_daily_census"](spark, SF))
    assert "ObjectHashAggregate" not in p and "percentile" not in p
    assert "Expand" not in p


def test_census_reads_each_fact_once(spark):
    """The distinct-count branches need no lab or billing column: Spark removes
    those LEFT joins (right side unique on the key), so lineitem is read once
    for labs and once for billing, not once per census branch."""
    p = plan(Q["mart_daily_census"](spark, SF))
    assert p.count("lineitem.parquet") == 2


def test_rolling_windows_are_bounded(spark):
    """No window over a patient alone: the rows come numbered, and a window holds a bucket of numbers and its halo."""
    p = plan(Q["silver_icu_vitals"](spark, SF))
    keyed = [line for line in p.splitlines() if "Window [" in line and "patient_id" in line]
    assert keyed and all("_bucket" in line.split("], [")[1] for line in keyed) and "SortMergeJoin" not in p


def test_census_exchanges(spark):
    """Over the model's table: four hash exchanges, no join."""
    from clinspark.operators import gold
    from clinspark.plans.catalog import Tables
    from clinspark.session import cut_lineage
    table = cut_lineage(Tables(spark, SF).int_patient_encounters(), "int")
    p = plan(gold.mart_daily_census(table))
    assert p.count("Exchange hashpartitioning") <= 4 and "Join" not in p


def test_quality_checks_scans(spark):
    """A pass per table, and one more for each further unique key: five tables and two keys; patients are two extracts, so two scans."""
    p = plan(Q["quality_checks"](spark, SF))
    assert p.count("Scan parquet") == 9 and "LeftAnti" not in p
    assert plan(Q["gate_decision"](spark, SF)).count("Scan parquet") == p.count("Scan parquet")
