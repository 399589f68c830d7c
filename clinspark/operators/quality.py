"""Declarative data-quality rules, suites, scores and the gate.

Rules are data. ``validate`` evaluates every row-local rule of one table
(not-null, in-set, range, date-range, unique) in a single aggregation pass;
foreign keys take one anti join each on pre-aggregated keys. Results are a
DataFrame (one row per check), never driver-side loops over data.

Departures from the source system, on purpose:
* range checks count every violating non-null row (the source re-indexed a
  filtered series and could miss violations);
* a given ``max_date`` is enforced (the source only switched the future test off);
* "now" is the run's ``as_of``.
"""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from .. import config as C
from ..functions.clinical import ts_lit


@dataclass(frozen=True)
class Rule:
    kind: str                      # not_null | unique | in_set | range | date_range | foreign_key | row_count
    column: str
    values: tuple = ()             # in_set: allowed values (None allowed = NULL valid)
    low: Any = None                # range / date_range bounds (inclusive)
    high: Any = None
    tol: float = 0.0               # pass when violation share < tol (custom checks)
    allow_null: bool = True        # foreign_key: NULL keys skipped
    ref: Any = field(default=None, compare=False, hash=False)   # (DataFrame, column) for foreign_key
    name: str = ""

    @property
    def check(self) -> str:
        if self.name:
            return self.name
        if self.kind == "range":
            return f"range::{self.column}[{_fmt(self.low)},{_fmt(self.high)}]"
        if self.kind == "foreign_key":
            return f"referential_integrity::{self.column}"
        return f"{self.kind}::{self.column}"


def _fmt(v) -> str:
    return "None" if v is None else str(v)


def NotNull(col: str, tol: float = 0.01) -> Rule:
    return Rule("not_null", col, tol=tol)


def Unique(col: str) -> Rule:
    return Rule("unique", col)


def InSet(col: str, values: Sequence, tol: float = 0.001) -> Rule:
    return Rule("in_set", col, values=tuple(values), tol=tol)


def Between(col: str, low=None, high=None, tol: float = 0.005) -> Rule:
    return Rule("range", col, low=low, high=high, tol=tol)


def DateBetween(col: str, low: str = C.DATE_MIN_DEFAULT, high: str | None = None, tol: float = 0.01) -> Rule:
    return Rule("date_range", col, low=low, high=high, tol=tol)


def ForeignKey(col: str, ref_df: DataFrame, ref_col: str, allow_null: bool = True, tol: float = 0.005) -> Rule:
    return Rule("foreign_key", col, ref=(ref_df, ref_col), allow_null=allow_null, tol=tol)


# ----------------------------------------------------------- expressions --

def lenient_timestamp(c: Column, dtype) -> Column:
    """H3: text to TIMESTAMP_NTZ, bad input to NULL, a trailing zone dropped."""
    if isinstance(dtype, (TimestampNTZType,)):
        return c
    if isinstance(dtype, (TimestampType, DateType)):
        return c.cast("timestamp_ntz")
    text = F.regexp_replace(c.cast("string"), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return text.try_cast("timestamp_ntz")


def in_set_valid(c: Column, values: Sequence) -> Column:
    """Null-safe membership: NULL is valid only when None is among ``values``."""
    non_null = [v for v in values if v is not None]
    member = F.coalesce(c.isin(*non_null), F.lit(False)) if non_null else F.lit(False)
    return member | (c.isNull() & F.lit(None in values))


LOCAL = ("not_null", "in_set", "range", "date_range")


def row_flags(rule: Rule, df: DataFrame, as_of: _dt.datetime = C.AS_OF) -> tuple[Column, Column]:
    """(violates, counts) of a row under a row-local rule; true only where it does."""
    c = F.col(rule.column)
    every = F.lit(True)
    if rule.kind == "not_null":
        return c.isNull(), every
    if rule.kind == "in_set":
        return ~in_set_valid(c, rule.values), every
    if rule.kind == "range":
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (c < F.lit(rule.low))
        if rule.high is not None:
            bad = bad | (c > F.lit(rule.high))
        return c.isNotNull() & bad, c.isNotNull()
    if rule.kind == "date_range":
        t = lenient_timestamp(c, df.schema[rule.column].dataType)
        lo = F.lit(rule.low).cast("timestamp_ntz")
        hi = (F.lit(rule.high).cast("timestamp_ntz") if rule.high is not None
              else F.timestamp_add("DAY", F.lit(C.FUTURE_DAYS_ALLOWED), ts_lit(as_of)))
        return t.isNull() | (t < lo) | (t > hi), every
    raise ValueError(rule.kind)


def _violation_exprs(rule: Rule, df: DataFrame, as_of: _dt.datetime) -> tuple[Column, Column]:
    """(violations, denominator) aggregate expressions of a row-local rule."""
    bad, counts = row_flags(rule, df, as_of)
    return F.count_if(bad), F.count_if(counts)


def rule_metrics(df: DataFrame, rules: Sequence[Rule], as_of: _dt.datetime = C.AS_OF) -> dict[str, Column]:
    """Aggregates of the row-local rules, to be observed on a write of ``df``: their checks then cost no scan."""
    found = {}
    for r in rules:
        if r.kind in LOCAL:
            found[f"bad {r.check}"], found[f"of {r.check}"] = _violation_exprs(r, df, as_of)
    return found


def orphans(df: DataFrame, fk: str, ref_df: DataFrame, ref_col: str, allow_null: bool = True) -> DataFrame:
    """C4: (fk value, n rows) for values not present in the reference keys.

    Child keys are counted per value first (map-side combine, so a hot key
    costs one row per partition), then anti-joined with the distinct parent
    keys. NULL keys are orphans only when ``allow_null`` is False.
    """
    child = df.select(F.col(fk).alias("_k"))
    if allow_null:
        child = child.where(F.col("_k").isNotNull())
    counts = child.groupBy("_k").agg(F.count(F.lit(1)).alias("n"))
    keys = ref_df.select(F.col(ref_col).alias("_k")).distinct()
    return counts.join(keys, "_k", "left_anti").withColumnRenamed("_k", fk)


def _repeats(df: DataFrame, column: str) -> DataFrame:
    """Rows beyond the first of their value; NULL is a value like any other."""
    per_value = df.groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    return per_value.select((F.col("n") - 1).alias("n"))


def validate(df: DataFrame, rules: Sequence[Rule], source: str = "table",
             as_of: _dt.datetime = C.AS_OF, with_count: bool = False) -> DataFrame:
    """Evaluate ``rules`` on ``df``: one row per check with
    (source, check, kind, violations, total, pct, passed, status).

    One aggregation pass computes every row-local rule and every total; a
    unique rule adds a count per value, an FK rule one anti join. The parts are
    stacked and summed per rule. Custom rules pass when
    violations / max(total, 1) < tol; unique needs 0. ``with_count`` adds a row
    of kind ``row_count`` whose total is the number of rows.
    """
    rules = [*rules, *([Rule("row_count", "*", name="row_count")] if with_count else [])]
    exprs, apart = [], []
    for i, r in enumerate(rules):
        if r.kind in ("foreign_key", "unique", "row_count"):
            v = F.lit(0)
            d = F.count(F.col(r.column)) if r.kind == "foreign_key" and r.allow_null else F.count(F.lit(1))
            if r.kind != "row_count":
                found = (_repeats(df, r.column) if r.kind == "unique"
                         else orphans(df, r.column, r.ref[0], r.ref[1], r.allow_null))
                apart.append(found.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))
                                  .select(F.lit(i).alias("_idx"), "violations", F.lit(0).cast("long").alias("total")))
        else:
            v, d = _violation_exprs(r, df, as_of)
        exprs.append(F.struct(F.lit(i).alias("_idx"), v.cast("long").alias("violations"), d.cast("long").alias("total")))
    out = df.agg(F.array(*exprs).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    for part in apart:
        out = out.unionByName(part)
    out = out.groupBy("_idx").agg(F.sum("violations").alias("violations"), F.sum("total").alias("total"))
    named = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("_idx") + 1)
    out = out.select(F.lit(source).alias("source"), named([r.check for r in rules]).alias("check"),
                     named([r.kind for r in rules]).alias("kind"), named([float(r.tol) for r in rules]).alias("tol"),
                     "violations", "total")
    return _judged(out)


def _judged(checks: DataFrame) -> DataFrame:
    """pct, passed and status of check rows; tol goes."""
    pct = F.col("violations") / F.greatest(F.col("total"), F.lit(1))
    passed = F.when(F.col("kind").isin("unique", "row_count"), F.col("violations") == 0).otherwise(pct < F.col("tol"))
    return (checks.withColumn("pct", pct).withColumn("passed", passed)
                  .withColumn("status", F.when(F.col("passed"), "PASS").otherwise("FAIL"))
                  .drop("tol"))


def invalid_samples(df: DataFrame, rule: Rule, k: int = 3, source: str = "table") -> DataFrame:
    """the first ``k`` distinct invalid values of an in-set rule, sorted (TakeOrdered)."""
    c = F.col(rule.column)
    vals = (df.where(~in_set_valid(c, rule.values)).select(c.cast("string").alias("value"))
              .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("value").asc_nulls_first()).limit(k))
    return vals.select(F.lit(source).alias("source"), F.lit(rule.check).alias("check"), "value")


# ----------------------------------------------------------------- suites --

def suite_rules(name: str, df, patient_ref: DataFrame | None = None) -> list[Rule]:
    """Q7: the per-source rule lists (fixed check list of the source system).

    ``df`` is the table (or just its column names); optional checks depend on
    which columns exist.
    """
    cols = set(df.columns) if hasattr(df, "columns") else set(df)
    pref = (patient_ref, "patient_id")
    if name == "patients":
        rules = [NotNull("patient_id"), NotNull("mrn"), Unique("patient_id"), Unique("mrn"),
                 InSet("gender", C.GENDER_VALUES), NotNull("zip_code"), NotNull("insurance_type"),
                 DateBetween("dob", "1900-01-01")]
        if "age_years" in cols:
            rules.append(Between("age_years", 0, 130))
        return rules
    if name == "encounters":
        rules = [NotNull("encounter_id"), NotNull("patient_id"), Unique("encounter_id"),
                 ForeignKey("patient_id", *pref, allow_null=False),
                 InSet("encounter_type", C.ENCOUNTER_TYPES), DateBetween("admit_datetime"),
                 NotNull("primary_diagnosis_icd10")]
        if "los_days" in cols:
            rules.append(Between("los_days", 0, 365))
        return rules
    if name == "labs":
        rules = [NotNull("lab_result_id"), NotNull("patient_id"), NotNull("loinc_code"),
                 ForeignKey("patient_id", *pref, allow_null=True),
                 InSet("abnormal_flag", ["N", "H", "L", "HH", "LL", None, "None"]),
                 DateBetween("collected_datetime"), DateBetween("resulted_datetime")]
        if "tat_hours" in cols:
            rules.append(Between("tat_hours", 0, 168))
        return rules
    if name == "billing":
        return [NotNull("claim_id"), NotNull("patient_id"), NotNull("cpt_code"),
                Between("charge_amount", 0, 1000000), InSet("claim_status", C.CLAIM_STATUSES),
                NotNull("payer_name")]
    if name == "icu_vitals":
        return [NotNull("vital_id"), NotNull("patient_id"), NotNull("timestamp"),
                Between("heart_rate", 20, 250), Between("systolic_bp", 40, 280),
                Between("spo2", 50, 100), Between("temperature_celsius", 28, 44)]
    raise KeyError(name)


SUITE_ORDER = ["patients", "encounters", "labs", "billing", "icu_vitals"]


CHECK_SCHEMA = ("source string, check string, kind string, violations long, total long, pct double, passed boolean, "
                "status string")


def run_checks(data: dict[str, DataFrame], patient_ref: DataFrame | None = None,
               as_of: _dt.datetime = C.AS_OF, with_count: bool = False, measured: dict[str, dict] | None = None) -> DataFrame:
    """Q7 over every present source: all check rows stacked (G1). No source gives no rows.

    One census per key: the rows of a referenced table and of all tables that
    refer to it are counted together per key value, so that its uniqueness and every
    foreign key onto it come from one exchange of that key, combined map-side. The
    row-local rules of a table ride along in one of its key counts; a table
    without any takes one plain aggregation. So a table is scanned once for all its
    rules, and once more for each further unique column.

    ``measured`` has, per source, the rows and the ``rule_metrics`` that were observed when it
    was written; such a source is read for its keys only.
    """
    ref = patient_ref if patient_ref is not None else data.get("patients")
    measured = measured or {}
    frames = {n: data[n] for n in SUITE_ORDER if n in data}
    rules: list[tuple[str, Rule]] = []
    for n, df in frames.items():
        own = [r for r in suite_rules(n, df, ref) if r.kind != "foreign_key" or r.ref[0] is not None]
        rules += [(n, r) for r in [*own, *([Rule("row_count", "*", name="row_count")] if with_count else [])]]
    if not rules:
        return SparkSession.getActiveSession().createDataFrame([], CHECK_SCHEMA)

    # census: (table, column) -> its members (table, column), the referenced one first
    census: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for n, r in rules:
        if r.kind == "unique":
            census.setdefault((n, r.column), [(n, r.column)])
        elif r.kind == "foreign_key":
            home = next((m for m, df in frames.items() if df is r.ref[0]), None)
            if home is None:
                home = "referenced"
                frames[home] = r.ref[0]
            members = census.setdefault((home, r.ref[1]), [(home, r.ref[1])])
            members += [(n, r.column)] if (n, r.column) not in members else []
    carrier = {}
    for key, members in census.items():
        for n, _ in members:
            carrier.setdefault(n, key)

    def local(n: str) -> list[tuple[int, Rule]]:
        return [(g, r) for g, (m, r) in enumerate(rules) if m == n and r.kind in (*LOCAL, "row_count")]

    def results(g: int, violations: Column, total: Column) -> Column:
        return F.struct(F.lit(g).alias("_g"), F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
                        F.coalesce(total, F.lit(0)).cast("long").alias("total"))

    parts, noted = [], []
    for n, df in frames.items():
        if n in measured:
            m = measured[n]
            noted += [(g, 0 if r.kind == "row_count" else m[f"bad {r.check}"], m["rows"] if r.kind == "row_count" else m[f"of {r.check}"])
                      for g, r in local(n)]
        elif n not in carrier and local(n):
            flags = {g: (F.lit(False), F.lit(True)) if r.kind == "row_count" else row_flags(r, df, as_of) for g, r in local(n)}
            parts.append(df.agg(F.array(*[results(g, F.count_if(bad), F.count_if(of)) for g, (bad, of) in flags.items()]).alias("a")))
    for key, members in census.items():
        rows, sums, checks = None, {}, []
        for i, (n, column) in enumerate(members):
            df, cols = frames[n], {"_k": F.col(column), f"_m{i}": F.lit(True)}
            sums[f"_m{i}"] = F.count_if(f"_m{i}")
            if carrier[n] == key and n not in measured and (n, column) == next(m for m in members if m[0] == n):
                for g, r in local(n):
                    if r.kind == "row_count":
                        checks.append(results(g, F.lit(0), F.sum(f"_m{i}")))
                        continue
                    cols[f"_b{g}"], cols[f"_o{g}"] = row_flags(r, df, as_of)
                    sums |= {f"_b{g}": F.count_if(f"_b{g}"), f"_o{g}": F.count_if(f"_o{g}")}
                    checks.append(results(g, F.sum(f"_b{g}"), F.sum(f"_o{g}")))
            picked = df.select(*[c.alias(name) for name, c in cols.items()])
            rows = picked if rows is None else rows.unionByName(picked, allowMissingColumns=True)
        per_key = rows.groupBy("_k").agg(*[c.alias(name) for name, c in sums.items()])
        known = F.col("_k").isNotNull()
        for g, (n, r) in enumerate(rules):
            if r.kind == "unique" and (n, r.column) == key:  # rows beyond the first of a value; NULL is one
                checks.append(results(g, F.sum(F.greatest(F.col("_m0") - 1, F.lit(0))), F.sum("_m0")))
            elif r.kind == "foreign_key" and (n, r.column) in members[1:]:
                own = F.col(f"_m{members.index((n, r.column))}")
                orphan = ~(known & (F.col("_m0") > 0)) & (known if r.allow_null else F.lit(True))
                checks.append(results(g, F.sum(F.when(orphan, own)), F.sum(F.when(known, own) if r.allow_null else own)))
        parts.append(per_key.agg(F.array(*checks).alias("a")))
    out = None
    for p in parts:
        p = p.select(F.explode("a").alias("r")).select("r.*")
        out = p if out is None else out.unionByName(p)
    if noted:
        rows = SparkSession.getActiveSession().createDataFrame(noted, "_g int, violations long, total long")
        out = rows if out is None else out.unionByName(rows)

    def named(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("_g") + 1)

    out = out.select(named([n for n, _ in rules]).alias("source"), named([r.check for _, r in rules]).alias("check"),
                     named([r.kind for _, r in rules]).alias("kind"), named([float(r.tol) for _, r in rules]).alias("tol"),
                     "violations", "total")
    return _judged(out)


def score_sources(checks: DataFrame, threshold: float = C.QUALITY_THRESHOLD) -> DataFrame:
    """Q8: per source score = passed / total checks, and the source gate on it, unrounded.

    Sources without records are skipped, as in the source system; their number
    comes from the ``row_count`` rows of ``checks`` (NULL without these).
    """
    real = F.col("kind") != "row_count"
    per = checks.groupBy("source").agg(
        F.count_if(real & F.col("passed")).alias("checks_passed"), F.count_if(real).alias("checks_total"),
        F.max(F.when(~real, F.col("total"))).alias("record_count"))
    return (per.where(F.coalesce(F.col("record_count") > 0, F.lit(True)) & (F.col("checks_total") > 0))
               .withColumn("score", F.col("checks_passed") / F.col("checks_total"))
               .withColumn("gate_passed", F.col("score") >= F.lit(threshold)))


def overall(scores: DataFrame, threshold: float = C.QUALITY_THRESHOLD) -> DataFrame:
    """Q9: overall = mean of the unrounded source scores, 0.0 without any; gate >= threshold."""
    return (scores.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("overall_score"), F.count(F.lit(1)).alias("sources"))
                  .withColumn("gate_passed", F.col("overall_score") >= F.lit(threshold)))


def gate_decision(scores: DataFrame, threshold: float = C.QUALITY_THRESHOLD) -> DataFrame:
    """Q10: the gate's one row with the decision a run takes and the sources that fail on their own, from one pass over the scores."""
    failing = F.array_join(F.sort_array(F.collect_list(F.when(~F.col("gate_passed"), F.col("source")))), ",")
    return (scores.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("overall_score"), F.count(F.lit(1)).alias("sources"),
                       failing.alias("failing_sources"))
                  .withColumn("gate_passed", F.col("overall_score") >= F.lit(threshold))
                  .select("overall_score", "sources", "gate_passed",
                          F.when(F.col("gate_passed"), "LOAD").otherwise("HALT").alias("decision"), "failing_sources"))


def record_estimates(scores: DataFrame) -> DataFrame:
    """Q11: passed = all records if the source gate passed, else int(n * score);
    failed = 0 or int(n * (1 - score)) - the two need not add up to n."""
    n, s = F.col("record_count"), F.col("score")
    return scores.select(
        "source", "record_count",
        F.when(F.col("gate_passed"), n).otherwise(F.floor(n * s)).cast("long").alias("passed_records"),
        F.when(F.col("gate_passed"), F.lit(0)).otherwise(F.floor(n * (F.lit(1) - s))).cast("long").alias("failed_records"))


# ------------------------------------------------- declared model tests --

def model_test(df: DataFrame, model: str, test: str, column: str, values: Sequence | None = None,
               low=None, high=None, where: str | None = None, ref: tuple | None = None) -> DataFrame:
    """Q13: one declared model test -> (model, test, column, failures).

    Failing rows as the model-test framework counts them: unique counts the
    duplicated values, accepted_values / relationships let NULL pass,
    accepted_range fails rows where NOT (low <= v <= high) is true.
    """
    c = F.col(column)
    base = df.where(where) if where else df
    if test == "unique":
        fails = (base.where(c.isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > 1).agg(F.count(F.lit(1)).alias("failures")))
    elif test == "not_null":
        fails = base.agg(F.count_if(c.isNull()).alias("failures"))
    elif test == "accepted_values":
        fails = base.agg(F.count_if(~c.isin(*values)).alias("failures"))
    elif test == "accepted_range":
        cond = F.lit(True)
        if low is not None:
            cond = cond & (c >= F.lit(low))
        if high is not None:
            cond = cond & (c <= F.lit(high))
        fails = base.agg(F.count_if(~cond).alias("failures"))
    elif test == "relationships":
        ref_df, ref_col = ref
        fails = orphans(base, column, ref_df, ref_col, allow_null=True).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
    else:
        raise ValueError(test)
    return fails.select(F.lit(model).alias("model"), F.lit(test).alias("test"),
                        F.lit(column).alias("column"), F.col("failures").cast("long").alias("failures"))


# Declared tests of the four models: (model, test, column, options) - fixed values.
MODEL_TESTS = [
    ("stg_patients", "unique", "patient_id", {}),
    ("stg_patients", "not_null", "patient_id", {}),
    ("stg_patients", "unique", "mrn", {}),
    ("stg_patients", "not_null", "mrn", {}),
    ("stg_patients", "not_null", "gender", {}),
    ("stg_patients", "accepted_values", "gender", {"values": C.GENDER_VALUES}),
    ("stg_patients", "not_null", "age_years", {}),
    ("stg_patients", "accepted_range", "age_years", {"low": 0, "high": 130}),
    ("stg_patients", "not_null", "insurance_type", {}),
    ("stg_patients", "accepted_values", "insurance_type", {"values": C.INSURANCE_ACCEPTED}),
    ("stg_encounters", "unique", "encounter_id", {}),
    ("stg_encounters", "not_null", "encounter_id", {}),
    ("stg_encounters", "not_null", "patient_id", {}),
    ("stg_encounters", "relationships", "patient_id", {"ref": ("stg_patients", "patient_id")}),
    ("stg_encounters", "not_null", "encounter_type", {}),
    ("stg_encounters", "accepted_values", "encounter_type", {"values": C.ENCOUNTER_TYPES}),
    ("stg_encounters", "accepted_range", "los_days", {"low": 0, "high": 365, "where": "los_days IS NOT NULL"}),
    ("int_patient_encounters", "unique", "encounter_id", {}),
    ("int_patient_encounters", "not_null", "encounter_id", {}),
    ("int_patient_encounters", "accepted_values", "encounter_risk_score", {"values": ["HIGH", "MEDIUM", "LOW"]}),
    ("mart_daily_census", "not_null", "census_date", {}),
    ("mart_daily_census", "accepted_range", "avg_los_days", {"low": 0, "high": 365}),
]

_ROW_LOCAL_TESTS = ("not_null", "accepted_values", "accepted_range")


def _failing(test: str, c: Column, opts: dict) -> Column:
    """Row condition of a failing row for a row-local model test."""
    if test == "not_null":
        cond = c.isNull()
    elif test == "accepted_values":
        cond = ~c.isin(*opts["values"])          # NULL gives NULL: passes, as in the framework
    else:
        ok = F.lit(True)
        if opts.get("low") is not None:
            ok = ok & (c >= F.lit(opts["low"]))
        if opts.get("high") is not None:
            ok = ok & (c <= F.lit(opts["high"]))
        cond = ~ok
    if opts.get("where"):
        cond = F.expr(opts["where"]) & cond
    return cond


def run_model_tests(models: dict[str, DataFrame], tests=MODEL_TESTS) -> DataFrame:
    """Q13: declared model tests -> (model, test, column, failures, status).

    Row-local tests of one model (not_null, accepted_values, accepted_range)
    share one aggregation pass; unique adds one per-value count, a
    relationship one anti join on pre-aggregated keys.
    """
    parts = []
    for model in dict.fromkeys(t[0] for t in tests):
        df = models[model]
        local = [t for t in tests if t[0] == model and t[1] in _ROW_LOCAL_TESTS]
        if local:
            structs = [F.struct(F.lit(m).alias("model"), F.lit(test).alias("test"), F.lit(col).alias("column"),
                                F.count_if(_failing(test, F.col(col), opts)).cast("long").alias("failures"))
                       for m, test, col, opts in local]
            parts.append(df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("r")).select("r.*"))
        for m, test, col, opts in tests:
            if m != model or test in _ROW_LOCAL_TESTS:
                continue
            ref = opts.get("ref")
            parts.append(model_test(df, m, test, col, ref=(models[ref[0]], ref[1]) if ref else None))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def declared_model_tests(stg_p: DataFrame, stg_e: DataFrame, int_pe: DataFrame, census: DataFrame) -> DataFrame:
    """Q13 on the four models."""
    return run_model_tests({"stg_patients": stg_p, "stg_encounters": stg_e,
                            "int_patient_encounters": int_pe, "mart_daily_census": census})


# ----------------------------------------------------- expectation suite --

@dataclass(frozen=True)
class Expectation:
    kind: str          # column_to_exist | not_null | unique | in_set | between
    column: str
    mostly: float = 1.0
    values: tuple = ()
    low: Any = None
    high: Any = None


PATIENT_EXPECTATIONS = [
    Expectation("column_to_exist", "patient_id"),
    Expectation("not_null", "patient_id", 1.0),
    Expectation("unique", "patient_id"),
    Expectation("not_null", "mrn", 1.0),
    Expectation("unique", "mrn"),
    Expectation("in_set", "gender", 0.999, tuple(C.GENDER_VALUES)),
    Expectation("not_null", "dob", 0.99),
    Expectation("between", "age_years", 0.999, low=0, high=130),
    Expectation("not_null", "insurance_type", 0.99),
    Expectation("in_set", "insurance_type", 0.99, tuple(C.INSURANCE_ACCEPTED)),
]


def expect(df: DataFrame, expectations: Sequence[Expectation], suite: str = "suite") -> DataFrame:
    """Q14: expectation results (suite, expectation, column, unexpected, element_count, success).

    success when 1 - unexpected/element_count >= mostly; not_null counts over
    all rows, in_set / between / unique over non-null values (NULLs ignored).
    Row-local expectations share one aggregation; each unique one adds a
    per-value count (one shuffle). An absent column fails all its expectations.
    """
    present = set(df.columns)
    local, parts = [], []
    for i, e in enumerate(expectations):
        if e.kind == "column_to_exist" or e.column not in present:
            parts.append((i, e, None))  # any expectation on an absent column fails as a row
        elif e.kind == "unique":
            parts.append((i, e, "unique"))
        else:
            local.append((i, e))
    exprs = []
    for i, e in local:
        c = F.col(e.column)
        if e.kind == "not_null":
            u, n = F.count_if(c.isNull()), F.count(F.lit(1))
        elif e.kind == "in_set":
            u, n = F.count_if(c.isNotNull() & ~c.isin(*e.values)), F.count(c)
        elif e.kind == "between":
            u, n = F.count_if(c.isNotNull() & ((c < F.lit(e.low)) | (c > F.lit(e.high)))), F.count(c)
        else:
            raise ValueError(e.kind)
        exprs.append(F.struct(F.lit(i).alias("idx"), u.cast("long").alias("unexpected"),
                              n.cast("long").alias("element_count")))
    frames = []
    if exprs:
        frames.append(df.agg(F.array(*exprs).alias("a")).select(F.explode("a").alias("r")).select("r.*"))
    for i, e, how in parts:
        if how is None:
            frames.append(df.sparkSession.range(1).select(
                F.lit(i).alias("idx"), F.lit(0 if e.column in present else 1).cast("long").alias("unexpected"),
                F.lit(1).cast("long").alias("element_count")))
        else:
            counts = df.where(F.col(e.column).isNotNull()).groupBy(e.column).agg(F.count(F.lit(1)).alias("n"))
            frames.append(counts.agg(
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("unexpected"),
                F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("element_count"))
                .select(F.lit(i).alias("idx"), "unexpected", "element_count"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    meta = df.sparkSession.createDataFrame(
        [(i, e.kind, e.column, float(e.mostly)) for i, e in enumerate(expectations)],
        "idx int, expectation string, column string, mostly double")
    frac = F.col("unexpected") / F.greatest(F.col("element_count"), F.lit(1))
    return (out.join(F.broadcast(meta), "idx")
               .select(F.lit(suite).alias("suite"), "idx", "expectation", "column", "unexpected", "element_count",
                       (F.lit(1.0) - frac >= F.col("mostly")).alias("success")))
