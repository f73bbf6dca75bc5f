"""Operators that watch builds: freshness, anomalies, counts, rules, drift, reconciliation, tracing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feeloom.functions.keys import fee_key
from feeloom.functions.money import MONEY_SCALE, exact_mean, to_units, units_to_double
from feeloom.operators.checks import beyond_tolerance, expected_ltv, unique
from feeloom.operators.staging import drop_incomplete
from feeloom.schemas import LTV_WINDOWS, ltv_columns
from feeloom.session import scratch_dir


def freshness(
    df: DataFrame, as_of: dt.date | None = None, max_age_days: int = 3, column: str = "fee_date"
) -> DataFrame:
    """One row: newest date, its age on ``as_of`` (default today), and whether it is too old."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    age = F.date_diff(today, F.col("latest")).cast("bigint")
    return df.agg(F.max(column).alias("latest")).select(
        F.col("latest"),
        age.alias("age_days"),
        F.coalesce(age > max_age_days, F.lit(True)).alias("stale"),
    )


def newest_file(df: DataFrame) -> DataFrame:
    """One row: newest modification time among the files ``df`` reads."""
    return df.agg(F.max("_metadata.file_modification_time").alias("newest_file"))


def _day_totals(fees: DataFrame, scale: int) -> DataFrame:
    return (
        fees.groupBy("fee_date")
        .agg(F.sum(to_units(F.col("fee_amount"), scale)).alias("units"), F.count("*").alias("fees"))
    )


def daily_anomalies(
    fees: DataFrame, days: int = 28, sigmas: float = 3.0, scale: int = MONEY_SCALE
) -> DataFrame:
    """Total per fee day against the mean and standard deviation of the ``days`` previous fee days.

    The window has no partition key; it runs over one row per calendar day, never over fees.
    """
    measured = _against_days_before(_day_totals(fees, scale), Window.orderBy("fee_date").rowsBetween(-days, -1), scale)
    off = F.abs(F.col("total_fees") - F.col("expected_fees")) > F.col("deviation") * F.lit(sigmas)
    return measured.withColumn("anomalous", F.coalesce(off, F.lit(False)))


def calendar_anomalies(
    fees: DataFrame, days: int = 28, sigmas: float = 3.0, scale: int = MONEY_SCALE
) -> DataFrame:
    """daily_anomalies() over the calendar: every day from the first fee to the last is a row, a silent one with 0 fees.

    A day is compared with the ``days`` calendar days before it (a RANGE of dates, so gaps count), silent ones included.
    ``silent`` days are anomalous whenever the days before had fees on at least half of them. Fees without a date take
    no part; no fees, no rows.
    """
    totals = _day_totals(fees.where(F.col("fee_date").isNotNull()), scale)
    span = totals.agg(F.min("fee_date").alias("first"), F.max("fee_date").alias("last")).where("first IS NOT NULL")
    calendar = span.select(F.explode(F.sequence("first", "last")).alias("fee_date"))
    zero = F.lit(0).cast("bigint")
    every = calendar.join(totals, "fee_date", "left").select(
        "fee_date", F.coalesce("units", zero).alias("units"), F.coalesce("fees", zero).alias("fees")
    )
    day = F.unix_date("fee_date")
    before = Window.orderBy(day).rangeBetween(-days, -1)
    busy = F.count_if(F.col("fees") > 0).over(before)
    measured = _against_days_before(every.withColumn("busy", busy), before, scale, ["busy"])
    silent = F.col("fees") == 0
    off = F.abs(F.col("total_fees") - F.col("expected_fees")) > F.col("deviation") * F.lit(sigmas)
    return measured.select(
        *[c for c in measured.columns if c not in ("busy", "n")],
        silent.alias("silent"),
        (F.coalesce(off, F.lit(False)) | (silent & (F.col("busy") * 2 >= F.col("n")) & (F.col("n") > 0))).alias("anomalous"),
    )


def _against_days_before(totals: DataFrame, before, scale: int, extra: Sequence[str] = ()) -> DataFrame:
    """Each day's total beside the exact mean and standard deviation of the rows in the window ``before`` it.

    With ``extra``, those columns and the number of rows ``n`` stay.
    """
    wide = F.col("units").cast("decimal(19,0)")
    stats = totals.select(
        "fee_date",
        "fees",
        "units",
        *extra,
        F.count("*").over(before).alias("n"),
        F.sum("units").over(before).alias("s"),
        F.sum(wide * wide).over(before).alias("ss"),
    )
    n, s = F.col("n"), F.col("s").cast("decimal(19,0)")
    spread = (F.col("ss") * n.cast("decimal(10,0)")).cast("decimal(38,0)") - s * s
    deviation = F.sqrt(spread.cast("double") / (n * (n - 1)).cast("double")) / F.lit(float(10**scale))
    enough = n >= 2
    return stats.select(
        "fee_date",
        "fees",
        units_to_double(F.col("units"), scale).alias("total_fees"),
        F.when(enough, exact_mean(F.col("s"), n, scale)).alias("expected_fees"),
        F.when(enough, F.round(deviation, 2)).alias("deviation"),
        *([*extra, "n"] if extra else []),
    )


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows), one row per table."""
    counts = [df.agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def record_counts(tables: Mapping[str, DataFrame], history_path: str, run_id: str) -> None:
    """Add this run's layer_counts() to the history table; repeating a run replaces its rows."""
    counts = layer_counts(tables).withColumn("run_id", F.lit(run_id))
    (
        counts.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(history_path)
    )


def count_changes(history: DataFrame, max_change: float = 0.2) -> DataFrame:
    """Runs in ``history`` (run_id, table, rows) whose row count moved by more than ``max_change`` since the run before."""
    previous = F.lag("rows").over(Window.partitionBy("table").orderBy("run_id"))
    return history.withColumn("previous_rows", previous).where(
        F.abs(F.col("rows") - F.col("previous_rows")) > F.col("previous_rows") * F.lit(max_change)
    )


@dataclass(frozen=True)
class Rule:
    """A declared expectation on one column: ``kind`` is 'not_null', 'unique' or 'between' (low, high inclusive)."""

    column: str
    kind: str
    low: object = None
    high: object = None

    @property
    def name(self) -> str:
        return f"{self.kind} {self.column}"

    def broken(self) -> Column:
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "between":
            return ~F.col(self.column).between(self.low, self.high)
        raise ValueError(f"unknown rule kind {self.kind!r}")


def rule_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations). Row rules share one aggregate pass; each unique rule groups by its column."""
    row_rules = [r for r in rules if r.kind != "unique"]
    parts = []
    if row_rules:
        counts = df.agg(*[F.count_if(r.broken()).alias(r.name) for r in row_rules])
        parts.append(counts.unpivot([], [f"`{r.name}`" for r in row_rules], "rule", "violations"))
    for rule in rules:
        if rule.kind == "unique":
            counted = unique(df, rule.column).agg(F.count("*").alias("violations"))
            parts.append(counted.select(F.lit(rule.name).alias("rule"), "violations"))
    return reduce(DataFrame.unionAll, parts)


def schema_drift(spark: SparkSession, actual: StructType, declared: StructType) -> DataFrame:
    """(column_name, declared_type, actual_type, drift) for columns that are missing, extra or of another type."""
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for name in [*want, *(c for c in have if c not in want)]:
        if name not in have:
            rows.append((name, want[name], None, "missing"))
        elif name not in want:
            rows.append((name, None, have[name], "extra"))
        elif want[name] != have[name]:
            rows.append((name, want[name], have[name], "type"))
    return spark.createDataFrame(rows, "column_name string, declared_type string, actual_type string, drift string")


def enforce_contract(df: DataFrame, declared: StructType) -> DataFrame:
    """``df`` in declared column order; raises if a column is missing, extra or of another type."""
    drift = schema_drift(df.sparkSession, df.schema, declared).collect()
    if drift:
        raise ValueError("schema drift: " + "; ".join(f"{r['column_name']} ({r['drift']})" for r in drift))
    return df.select(*declared.fieldNames())


def matured_clients(clients: DataFrame, as_of: dt.date, months: int = max(LTV_WINDOWS)) -> DataFrame:
    """Clients whose whole window of ``months`` lies before or on ``as_of``."""
    return clients.where(F.add_months("first_fee_date", months) <= F.lit(as_of))


def reconcile_ltv(
    fees: DataFrame, ltv: DataFrame, windows: Sequence[int] = LTV_WINDOWS, scale: int = MONEY_SCALE
) -> DataFrame:
    """Clients missing on either side or with differing values: (client_id, status, expected_ltv_total, actual_ltv_total)."""
    names = ltv_columns(windows)
    actual = ltv.select("client_id", *[F.col(c).alias(f"actual_{c}") for c in names])
    both = expected_ltv(fees, windows, scale).join(actual, "client_id", "full")
    differs = beyond_tolerance([(F.col(f"expected_{c}"), F.col(f"actual_{c}")) for c in names])
    status = (
        F.when(F.col("actual_ltv_total").isNull(), "missing in report")
        .when(F.col("expected_ltv_total").isNull(), "missing in fees")
        .when(differs, "differs")
    )
    return both.select("client_id", status.alias("status"), "expected_ltv_total", "actual_ltv_total").where(
        "status IS NOT NULL"
    )


def compare_builds(
    before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], money: Mapping[str, str]
) -> DataFrame:
    """Row counts and money totals of two builds: (table, measure, before, after, difference).

    ``money`` names the amount column of a table; tables of only one build have NULL on the other side.
    """

    def measures(tables: Mapping[str, DataFrame], side: str) -> DataFrame:
        parts = []
        for name, df in tables.items():
            sums = [F.count("*").cast("double").alias("rows")]
            if name in money:
                sums.append(units_to_double(F.sum(to_units(F.col(money[name])))).alias(money[name]))
            totals = df.agg(*sums)
            long = totals.unpivot([], totals.columns, "measure", side)
            parts.append(long.select(F.lit(name).alias("table"), "measure", side))
        return reduce(DataFrame.unionAll, parts)

    joined = measures(before, "before").join(measures(after, "after"), ["table", "measure"], "full")
    change = F.round((F.col("after") - F.col("before")).cast("decimal(38,6)"), 2).cast("double")
    return joined.withColumn("difference", change)


def trace_to_raw(raw: DataFrame, fees: DataFrame, clients: DataFrame, scale: int = MONEY_SCALE) -> DataFrame:
    """Raw rows, copies included, behind the figures of ``clients`` (a frame with client_id), with their fee_id.

    Read ``raw`` with ``_metadata.file_path`` selected to trace on to the file. ``clients`` is written first: its size is known
    then, and if they are few, the rows of all others are passed over where they are read.
    """
    spark = clients.sparkSession
    path = scratch_dir(spark, "traced-clients")
    clients.select("client_id").write.parquet(path)
    clients = spark.read.schema(clients.select("client_id").schema).parquet(path)
    counted = fees.join(clients.select("client_id"), "client_id", "left_semi").select("fee_id")
    # The key holds the client, so only rows of these clients are hashed and dealt out.
    served = drop_incomplete(raw).join(clients.select("client_id"), "client_id", "left_semi")
    complete = served.withColumn("fee_id", fee_key(scale))
    return complete.join(counted, "fee_id", "left_semi")


def trace_to_file(raw: DataFrame, fees: DataFrame, clients: DataFrame, scale: int = MONEY_SCALE) -> DataFrame:
    """trace_to_raw() down to the file: ``raw`` was loaded by read_fees_csv_traced() and written.

    Adds source_row, the number of the record in source_file, from 1 and without the header. The first record of a file
    is found by a map-side minimum over all its rows, one row for each file from then on.
    """
    firsts = raw.groupBy("source_file").agg(F.min("source_id").alias("first_id"))
    traced = trace_to_raw(raw, fees, clients, scale).join(firsts, "source_file")
    return traced.withColumn("source_row", F.col("source_id") - F.col("first_id") + 1).drop("first_id", "source_id")


def row_fingerprints(df: DataFrame, by: str, key: str) -> DataFrame:
    """(``by``, rows, fingerprint) for each value of ``by``: a checksum of its rows that does not depend on their order.

    Two 32-bit halves of each row's hash are summed, so the sums stay within a BIGINT, copies count, and the aggregate is partial.
    NULLs are told from texts. ``key`` is hashed like any column; it is named here so that a table without it fails early.
    """
    names = sorted(df.columns)
    df.select(key)
    parts = [p for c in names for p in (F.col(c).isNull(), F.col(c))]
    h = F.xxhash64(*parts)
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")), F.shiftrightunsigned(h, 32)
    sums = df.select(by, low.alias("low"), high.alias("high")).groupBy(by).agg(F.count("*").alias("rows"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    return sums.select(by, "rows", F.concat_ws(":", "low", "high").alias("fingerprint"))


def changed_rows(before: DataFrame, after: DataFrame, by: str = "fee_date", key: str = "fee_id") -> DataFrame:
    """(``by``, ``key``, change) of the rows that two builds of a table do not share: "added", "removed" or "changed".

    First the fingerprints of both builds are compared, one row for each day; then rows are compared only for the days that
    differ, which on tables partitioned by ``by`` are all that is read the second time. ``key`` is unique in each
    build; a NULL day or key equals another NULL. Columns that only one build has are not compared.
    """
    shared = [c for c in before.columns if c in after.columns]
    before, after = before.select(*shared), after.select(*shared)
    left, right = (row_fingerprints(df, by, key).select(F.col(by).alias("d"), F.col("fingerprint").alias(name)) for df, name in ((before, "f"), (after, "g")))
    differ = left.withColumnRenamed("d", "d1").join(right.withColumnRenamed("d", "d2"), F.expr("d1 <=> d2"), "full").where("NOT (f <=> g)")
    # One row for each day.
    days = [r["d"] for r in differ.select(F.coalesce("d1", "d2").alias("d")).collect()]
    known = [d for d in days if d is not None]
    chosen = F.col(by).isin(known) | (F.col(by).isNull() if len(known) < len(days) else F.lit(False))
    others = [c for c in shared if c not in (by, key)]

    def side(df: DataFrame, tag: str) -> DataFrame:
        content = F.xxhash64(*[p for c in others for p in (F.col(c).isNull(), F.col(c))]) if others else F.lit(0)
        return df.where(chosen).select(F.col(by).alias(f"{tag}_by"), F.col(key).alias(f"{tag}_key"), content.alias(f"{tag}_content"))

    both = side(before, "b").join(side(after, "a"), F.expr("b_by <=> a_by AND b_key <=> a_key"), "full")
    change = F.when(F.col("b_content").isNull(), "added").when(F.col("a_content").isNull(), "removed").when(F.col("a_content") != F.col("b_content"), "changed")
    return both.select(F.coalesce("b_by", "a_by").alias(by), F.coalesce("b_key", "a_key").alias(key), change.alias("change")).where("change IS NOT NULL")
