"""Reconciliation: prove two versions of a table equal (REC-01..14, SET-02..04).

Differences stay distributed: an operator returns DataFrames (metrics rows and
difference rows); only the small metrics rows and a ``limit(10)`` sample ever
reach the driver, and only when the caller asks for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X

OK, DIVERGENT, SKIPPED = "OK", "DIVERGENTE", "PULADA"
SIDE_A, SIDE_B = "only_in_a", "only_in_b"
COPIES_AT_ONCE = 10_000
ROWS_A_TASK = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a shuffle of so many rows: those of the session, and more where a
    task would hold more than ``ROWS_A_TASK`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))


# ---------------------------------------------------------------------------
# SET-02 / REC-05 / REC-06: symmetric difference
# ---------------------------------------------------------------------------
def symmetric_diff(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None,
                   strict: bool = False, side_col: str = "side") -> DataFrame:
    """Rows of A not in B and rows of B not in A, tagged by side.

    ``strict=False`` is MINUS semantics (EXCEPT DISTINCT, NULL equals NULL,
    multiplicity invisible); ``strict=True`` is EXCEPT ALL, so a duplicated row
    shows up as a difference.

    Both directions come from ONE aggregation over the tagged union of the two
    inputs, grouped by every compared column: each side is read once and
    shuffled once, and identical rows are combined map-side (a row repeated a
    billion times on one side costs one partial-aggregate entry per task), where
    two ``except`` calls would read and shuffle each input twice.
    """
    cols = list(columns or a.columns)
    tagged = (a.select(*cols, F.lit(1).alias("_na"), F.lit(0).alias("_nb"))
              .unionByName(b.select(*cols, F.lit(0).alias("_na"), F.lit(1).alias("_nb"))))
    g = tagged.groupBy(*cols).agg(F.sum("_na").alias("_na"), F.sum("_nb").alias("_nb"))
    side = F.when(F.col("_na") > F.col("_nb"), F.lit(SIDE_A)).otherwise(F.lit(SIDE_B))
    if not strict:
        return (g.where((F.col("_na") > 0) != (F.col("_nb") > 0))
                 .select(*cols, side.alias(side_col)))
    # EXCEPT ALL both ways: |na - nb| copies of the row on the larger side, in
    # two steps so that no array grows with the number of copies beyond its root
    d = g.where(F.col("_na") != F.col("_nb")).withColumn("_n", F.abs(F.col("_na") - F.col("_nb")))
    d = d.withColumn("_m", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES_AT_ONCE))))
    left = F.least(F.lit(COPIES_AT_ONCE).cast("long"), F.col("_n") - F.col("_m") * COPIES_AT_ONCE)
    return d.select(*cols, side.alias(side_col), F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("_i")).drop("_i")


def one_sided_diff(old: DataFrame, new: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``old`` missing from ``new``: the superset regression (REC-11).

    One aggregation over the tagged union, dealt by a hash of the row to as many tasks as
    the rows ask for, so what a task holds does not grow with the tables."""
    from .digests import row_hash
    cols = list(columns or old.columns)
    n = tasks_for(old.sparkSession, old.count() + new.count())
    tagged = old.select(*cols, F.lit(False).alias("_new")).unionByName(new.select(*cols, F.lit(True).alias("_new")))
    dealt = tagged.withColumn("_row", row_hash(tagged, cols)).repartition(n, "_row")
    return dealt.groupBy("_row", *[F.col(f"`{c}`") for c in cols]).agg(F.max("_new").alias("_new")).where(~F.col("_new")).select(*[F.col(f"`{c}`") for c in cols])


def null_normalised(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    """NVL(c, ' ') on compare columns before a MINUS (REC-12)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


# ---------------------------------------------------------------------------
# SET-04 / REC-07: column intersection
# ---------------------------------------------------------------------------
def column_sets(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ()) -> tuple[list, list, list]:
    """(common, only_a, only_b) column names, in A's order; ``ignore`` dropped."""
    ig = {c.upper() for c in ignore}
    ca = [c for c in a.columns if c.upper() not in ig]
    cb = [c for c in b.columns if c.upper() not in ig]
    common = [c for c in ca if c in cb]
    return common, [c for c in ca if c not in cb], [c for c in cb if c not in ca]


def common_columns_diff(a: DataFrame, b: DataFrame, ignore: Sequence[str] = (),
                        strict: bool = False) -> DataFrame:
    common, _, _ = column_sets(a, b, ignore)
    return symmetric_diff(a, b, common, strict)


# ---------------------------------------------------------------------------
# REC-01 / REC-02 / REC-03 / REC-04: count checks
# ---------------------------------------------------------------------------
def count_status(source_count: Column, target_count: Column, multi_writer: Column | bool = False) -> Column:
    """OK when equal; a multi-writer table tolerates a surplus but not a deficit."""
    mw = multi_writer if isinstance(multi_writer, Column) else F.lit(bool(multi_writer))
    return (F.when(source_count.isNull() | target_count.isNull(), F.lit(SKIPPED))
            .when(source_count == target_count, F.lit(OK))
            .when(mw & (target_count > source_count), F.lit(OK))
            .otherwise(F.lit(DIVERGENT)))


def count_check(name: str, source: DataFrame, target: DataFrame, scope: Column | None = None,
                widened_scope: Column | None = None, multi_writer: bool = False) -> DataFrame:
    """One metrics row: source count in scope, target count, status, and the
    widened-scope alert (a non-deciding third count, REC-02).

    Both sides are tagged, unioned and counted in one aggregate: one pass, no
    join and no driver round trip.
    """
    sc = scope if scope is not None else F.lit(True)
    wc = widened_scope if widened_scope is not None else F.lit(None).cast("boolean")
    s = source.select(F.lit(True).alias("_src"), sc.alias("_in"), wc.alias("_wide"))
    t = target.select(F.lit(False).alias("_src"), F.lit(None).cast("boolean").alias("_in"),
                      F.lit(None).cast("boolean").alias("_wide"))
    agg = s.unionByName(t).agg(
        F.count(F.when(F.col("_src") & F.col("_in"), 1)).alias("source_count"),
        F.count(F.when(~F.col("_src"), 1)).alias("target_count"),
        F.count(F.when(F.col("_src") & F.col("_wide"), 1)).alias("_w"))
    widened = (F.col("_w") if widened_scope is not None else F.lit(None).cast("long"))
    return agg.select(
        F.lit(name).alias("table_name"), "source_count", "target_count",
        count_status(F.col("source_count"), F.col("target_count"), multi_writer).alias("status"),
        widened.alias("widened_count"),
        F.coalesce(widened > F.col("source_count"), F.lit(False)).alias("alert"))


def skipped(name: str, spark) -> DataFrame:
    return spark.createDataFrame([(name, None, None, SKIPPED, None, False)],
                                 "table_name string, source_count long, target_count long, "
                                 "status string, widened_count long, alert boolean")


def summary(checks: DataFrame) -> DataFrame:
    """Totals per status and number of alerts (REC-13)."""
    return checks.groupBy("status").agg(F.count(F.lit(1)).alias("n_tables"),
                                        F.sum(F.col("alert").cast("int")).cast("long").alias("n_alerts"))


# ---------------------------------------------------------------------------
# REC-08 / REC-09 / REC-10: cutoff and stability windows
# ---------------------------------------------------------------------------
def cutoff_rules(tag_col: str, rules: Mapping[object, Column]) -> Column:
    """OR of ``(tag == k) & condition`` (per-block cutoff rules)."""
    cond = F.lit(False)
    for k, c in rules.items():
        cond = cond | ((F.col(tag_col) == F.lit(k)) & c)
    return cond


def stable_window(date_col: str, as_of, days: int = 2, month_tags: Sequence = (),
                  tag_col: str | None = None, month_date_col: str | None = None) -> Column:
    """Rows old enough to be stable: up to the midnight ``days`` days before the day
    of ``as_of``, that moment included; blocks listed in ``month_tags`` (month
    aggregates, dated by ``month_date_col``) ignore the whole current month."""
    today = F.to_date(F.lit(as_of))
    cond = F.col(date_col).cast("timestamp_ntz") <= (today - F.expr(f"INTERVAL {int(days)} DAYS")).cast("timestamp_ntz")
    if month_tags and tag_col:
        month_cond = F.to_date(month_date_col or date_col) < F.trunc(F.lit(as_of).cast("date"), "MM")
        cond = F.when(F.col(tag_col).isin(*month_tags), month_cond).otherwise(cond)
    return cond


def sample(diff: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First n differing rows in a total order (SRT-02)."""
    return diff.orderBy(*[X.asc(c) for c in order]).limit(n)


# ---------------------------------------------------------------------------
# AGG-12: monthly control totals on two versions
# ---------------------------------------------------------------------------
def control_totals(a: DataFrame, b: DataFrame, date_col: str, type_col: str,
                   value_col: str) -> DataFrame:
    """Per (month, type): count and exact sum on both versions, full join, diff."""
    def tot(df, sfx):
        return (df.groupBy(X.month_start(date_col).alias("month_start"), F.col(type_col))
                  .agg(F.count(F.lit(1)).alias(f"n_{sfx}"),
                       F.sum(X.money(df, value_col)).alias(f"sum_{sfx}")))
    j = tot(a, "a").join(tot(b, "b"), on=["month_start", type_col], how="full")
    return j.select(
        "month_start", type_col,
        F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"),
        F.col("sum_a").cast("double").alias("sum_a"), F.col("sum_b").cast("double").alias("sum_b"),
        (F.coalesce("sum_a", F.lit(0)) - F.coalesce("sum_b", F.lit(0))).cast("double").alias("sum_diff"))


# ---------------------------------------------------------------------------
# REC-14: freshness
# ---------------------------------------------------------------------------
def freshness(name: str, df: DataFrame, load_col: str, threshold) -> DataFrame:
    """max(load timestamp) of an input and whether it reaches the threshold."""
    return df.agg(F.max(load_col).alias("last_load")).select(
        F.lit(name).alias("table_name"), "last_load",
        F.coalesce(F.col("last_load") >= F.lit(threshold).cast("timestamp_ntz"),
                   F.lit(False)).alias("fresh"))
