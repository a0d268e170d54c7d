"""Driver queries: every operator group exercised on the test tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  The matching ANSI SQL (the DuckDB oracle) lives in
:mod:`tierwise.plans.oracle` under the same key; computed columns carry the same
alias in both.  Sums of money/quantity columns are exact DECIMAL sums returned
as DOUBLE; row-level arithmetic stays DOUBLE in the same operation order as the
SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators import blocks as B
from ..operators import digests as D
from ..operators import heavy_keys as HK
from ..operators import intervals as I
from ..operators import merge as M
from ..operators import reconcile as R
from ..operators import rolling as RO
from ..operators.ingest import ingest, run_tables
from ..session import scratch_path
from ..sources import drift as DR
from ..sources import profiles as P
from ..sources import ranges as RG
from ..sources import scan
from ..sources import schema as S
from ..sources import sheets
from ..sources.catalog import TableSpec
from ..sources.store import VersionedTable
from ..streaming.incremental import incremental_ingest
from .main_products import MAIN_QUERIES
from .product_queries import PRODUCT_QUERIES

# Fixed as-of instants of the driver queries.
AS_OF = "2001-08-01 00:00:00"           # orders / lineitem
EVENTS_AS_OF = "2024-01-31 00:00:00"    # events
LOOKBACK_DAYS = 60


def tbl(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ts(v: str):
    return F.lit(v).cast("timestamp_ntz")


ORDERS_SPEC = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_orderdate",
                        company_col="o_orderstatus", company_values=("F", "O"))
LINE_KEYS = ["l_orderkey", "l_linenumber"]


# ---------------------------------------------------------------------------
# Scans (SRC)
# ---------------------------------------------------------------------------
def scoped_lookback(spark, d):
    return scan.window_scan(tbl(spark, d, "orders"), ORDERS_SPEC, AS_OF, LOOKBACK_DAYS)


def lookback_fallback(spark, d):
    o = tbl(spark, d, "orders").withColumn(
        "o_changed", F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")))
    spec = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_changed",
                     fallback_col="o_orderdate")
    return scan.window_scan(o, spec, AS_OF).select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_changed",
        F.when(F.col("o_changed").isNull(), "fallback").otherwise("audit").alias("window_source"))


def lookback_sentinel(spark, d):
    o = tbl(spark, d, "orders").withColumn(
        "o_audit", F.when(F.col("o_orderstatus") == "P", ts(X.SENTINEL_DATE + " 00:00:00"))
        .otherwise(F.col("o_orderdate")))
    spec = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_audit",
                     sentinel=X.SENTINEL_DATE)
    return scan.window_scan(o, spec, AS_OF).select("o_orderkey", "o_orderstatus", "o_audit",
                                                   "o_orderdate")


# Inline override tables (SRC-16): bounded constants, broadcast.
NATION_ID_OVERRIDES = [(3, "NATION THREE (BY ID)"), (7, "NATION SEVEN (BY ID)")]
NATION_NAME_OVERRIDES = [("NATION_3", "NATION THREE (BY NAME)"), ("NATION_11", "NATION ELEVEN (BY NAME)")]


def override_priority(spark, d):
    """Display name = id override, else name override, else the cleaned name."""
    n = tbl(spark, d, "nation")
    by_id = F.broadcast(spark.createDataFrame(NATION_ID_OVERRIDES, "o_id int, id_name string"))
    by_name = F.broadcast(spark.createDataFrame(NATION_NAME_OVERRIDES, "o_name string, name_name string"))
    j = (n.join(by_id, n.n_nationkey == by_id.o_id, "left")
          .join(by_name, F.lower(n.n_name) == F.lower(by_name.o_name), "left"))
    default = F.upper(F.replace(F.col("n_name"), F.lit("_"), F.lit(" ")))
    return j.select(
        "n_nationkey", "n_name", F.coalesce("id_name", "name_name", default).alias("display_name"),
        F.when(F.col("id_name").isNotNull(), "id").when(F.col("name_name").isNotNull(), "name")
        .otherwise("default").alias("name_source"))


def key_universe(spark, d):
    spec = TableSpec(name="lineitem", keys=tuple(LINE_KEYS), company_col="l_linestatus",
                     company_values=("O",))
    return scan.key_universe(tbl(spark, d, "lineitem"), spec)


def column_profile(spark, d):
    return S.column_profile(tbl(spark, d, "customer"), "customer").unionByName(
        S.column_profile(tbl(spark, d, "part"), "part"))


def merged_profiles(spark, d):
    """Profiles of each month of two tables, merged into one row per column (SRC-20):
    the exact figures of the report; months are added up, no row is read again."""
    li, o = tbl(spark, d, "lineitem"), tbl(spark, d, "orders")
    parts = (P.part_profiles(li, "lineitem", F.date_format("l_shipdate", "yyyy-MM"))
             .unionByName(P.part_profiles(o, "orders", F.date_format("o_orderdate", "yyyy-MM"))))
    return P.report(P.merge_profiles(parts)).select(
        "table_name", "column_name", "ordinal", "data_type", "n_rows", "n_nulls", "n_blank", "n_digits", "min_length", "max_length", "sink_type")


def multi_scope(spark, d):
    c = tbl(spark, d, "customer")
    spec = TableSpec(name="customer", keys=("c_custkey",), company_col="c_mktsegment",
                     company_values=("BUILDING", "MACHINERY"))
    scoped = scan.snapshot_scan(c, spec).where(~F.col("c_nationkey").isin(0, 1))
    nation = tbl(spark, d, "nation")          # global table: unscoped scan
    return scoped.join(nation, scoped.c_nationkey == nation.n_nationkey, "left").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "n_name")


def declared_schema(spark, d):
    """Dictionary rows profiled from the data -> source types -> Spark/sink types.

    The dictionary of each table is produced by one aggregate pass (max text
    length, max integer digits); the typed empty table is then created in the
    shared folder from the mapped schema (SNK-03) and its column list checked.
    """
    frames = []
    for name in ("orders", "lineitem"):
        df = tbl(spark, d, name)
        aggs, rows = [], []
        for i, f in enumerate(df.schema.fields):
            c = F.col(f.name)
            if isinstance(f.dataType, T.StringType):
                aggs.append(F.max(F.length(c)).alias(f"_a{i}"))
                dt, ln, pr, sc = F.lit("VARCHAR2"), F.col(f"_a{i}"), F.lit(None).cast("int"), F.lit(None).cast("int")
            elif isinstance(f.dataType, (T.LongType, T.IntegerType)):
                aggs.append(F.max(F.length(F.abs(c).cast("string"))).alias(f"_a{i}"))
                dt, ln, pr, sc = F.lit("NUMBER"), F.lit(None).cast("int"), F.col(f"_a{i}"), F.lit(0)
            elif isinstance(f.dataType, T.DoubleType):
                aggs.append(F.lit(None).alias(f"_a{i}"))
                dt, ln, pr, sc = F.lit("NUMBER"), F.lit(None).cast("int"), F.lit(18), F.lit(2)
            else:
                aggs.append(F.lit(None).alias(f"_a{i}"))
                dt, ln, pr, sc = F.lit("DATE"), F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int")
            rows.append(F.struct(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
                                 F.lit(i + 1).alias("column_id"), dt.alias("data_type"),
                                 ln.cast("int").alias("data_length"), pr.cast("int").alias("data_precision"),
                                 sc.cast("int").alias("data_scale")))
        frames.append(df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    dic = frames[0].unionByName(frames[1])
    typed = dic.select("*", _sink_type_expr().alias("sink_type"), _spark_type_expr().alias("spark_type"))
    # SNK-03: create the typed empty table from the dictionary and verify it
    # (the dictionary is one row per column: collected once for both tables)
    dic_rows = dic.collect()
    for name in ("orders", "lineitem"):
        st = S.dictionary_to_schema(dic_rows, name)
        t = VersionedTable(spark, scratch_path(spark, f"declared_{name}"))
        t.create_empty(st)
        if t.read().columns != [f.name for f in st.fields]:
            raise AssertionError(f"typed empty table for {name} lost columns")
    return typed


def _sink_type_expr():
    t, p, s, n = F.col("data_type"), F.col("data_precision"), F.col("data_scale"), F.col("data_length")
    is_int = (t == "NUMBER") & (s.isNull() | (s == 0)) & (p.isNull() | (p <= S.INTEGER_MAX_PRECISION))
    return (F.when(is_int, F.lit("INTEGER"))
            .when(t == "NUMBER", F.concat(F.lit("NUMERIC("), F.coalesce(p, F.lit(38)).cast("string"), F.lit(","),
                                          F.coalesce(s, F.lit(10)).cast("string"), F.lit(")")))
            .when(t == "DATE", F.lit("DATETIME"))
            .when(n > S.TEXT_LIMIT, F.lit("CLOB"))
            .otherwise(F.concat(F.lit("VARCHAR("), (F.coalesce(n, F.lit(0)) + S.TEXT_MARGIN_SOURCE).cast("string"),
                                F.lit(")"))))


def _spark_type_expr():
    t, p, s = F.col("data_type"), F.col("data_precision"), F.col("data_scale")
    is_int = (t == "NUMBER") & (s.isNull() | (s == 0)) & (p.isNull() | (p <= S.INTEGER_MAX_PRECISION))
    return (F.when(is_int, F.lit("bigint"))
            .when(t == "NUMBER", F.concat(F.lit("decimal("), F.coalesce(p, F.lit(38)).cast("string"), F.lit(","),
                                          F.coalesce(s, F.lit(10)).cast("string"), F.lit(")")))
            .when(t == "DATE", F.lit("timestamp_ntz"))
            .otherwise(F.lit("string")))


# ---------------------------------------------------------------------------
# Merge / dedup / sweep (MRG)
# ---------------------------------------------------------------------------
def dedup_first(spark, d):
    return M.dedup_first(tbl(spark, d, "lineitem"), LINE_KEYS, order=["l_shipdate"])


def key_grain_report(spark, d):
    return M.key_grain_report(tbl(spark, d, "lineitem"), LINE_KEYS)


def _upsert_inputs(spark, d):
    o = tbl(spark, d, "orders")
    target = o.where(F.col("o_orderdate") < ts("2001-01-01 00:00:00"))
    batch = o.where(F.col("o_orderdate") >= ts("2000-07-01 00:00:00")).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus")))
    return target, batch


def upsert_snapshot(spark, d):
    target, batch = _upsert_inputs(spark, d)
    return M.upsert(target, batch, ["o_orderkey"], order=["o_orderdate"])


def insert_if_absent(spark, d):
    """Key-only table of (customer, status) pairs loaded up to 2000, then the
    full history merged in: only new pairs are inserted (MRG-03)."""
    o = tbl(spark, d, "orders")
    pairs = o.select("o_custkey", "o_orderstatus")
    target = o.where(F.col("o_orderdate") < ts("2000-01-01 00:00:00")) \
              .select("o_custkey", "o_orderstatus").distinct()
    return M.insert_if_absent(target, pairs, ["o_custkey", "o_orderstatus"])


def _universe(spark, d):
    return tbl(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))


def orphan_sweep(spark, d):
    kept, _ = M.orphan_sweep(tbl(spark, d, "orders"), _universe(spark, d), ["o_orderkey"])
    return kept


def orphan_sweep_scoped(spark, d):
    kept, _ = M.orphan_sweep(tbl(spark, d, "orders"), _universe(spark, d), ["o_orderkey"],
                             scope=F.col("o_orderstatus") == "O")
    return kept


def range_sweep(spark, d):
    """``orphan_sweep_scoped`` in two phases: ranges of keys, then the suspects only."""
    kept, _ = D.range_sweep(tbl(spark, d, "orders"), _universe(spark, d), ["o_orderkey"], scope=F.col("o_orderstatus") == "O")
    return kept


def range_sweep_removed(spark, d):
    """The line items whose (order, part) is not sold by a small customer's order any more."""
    li, o, c = tbl(spark, d, "lineitem"), tbl(spark, d, "orders"), tbl(spark, d, "customer")
    n = R.tasks_for(spark, li.count())
    sold = o.join(c.where(F.col("c_acctbal") > -900), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    live = li.repartition(n, "l_orderkey").join(sold.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    _, removed = D.range_sweep(li, live, ["l_orderkey", "l_partkey"])
    return removed


def tie_break_reference(spark, d):
    ref = (tbl(spark, d, "lineitem")
           .where((F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= ts("2001-06-01 00:00:00")))
           .select(F.col("l_partkey").alias("p_partkey")))
    return M.tie_break_reference(tbl(spark, d, "part"), "p_brand", "p_partkey", ref, ["p_partkey"])


def safe_key(spark, d):
    o = tbl(spark, d, "orders")
    ls = tbl(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus").distinct()
    j = o.join(ls, "o_orderkey", "left").withColumn("line_status_key", X.null_safe_key("l_linestatus"))
    return j.groupBy("o_orderstatus", "line_status_key").agg(F.count(F.lit(1)).alias("n_rows"))


def full_refresh_audit(spark, d):
    """Ingest orders twice through the dispatcher into the shared folder.

    Run 1 is a first load (snapshot replace).  Run 2 reads a second source
    system that no longer carries the orders without lines: a 60-day window is
    merged and the scoped orphan sweep removes the vanished keys.
    """
    o = tbl(spark, d, "orders")
    spec = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_orderdate",
                     company_col="o_orderstatus", company_values=("F", "O", "P"))
    target = VersionedTable(spark, scratch_path(spark, "full_refresh_orders"))
    r1 = ingest(spec, o, target, AS_OF)
    src2 = o.join(_universe(spark, d), "o_orderkey", "left_semi")
    r2 = ingest(spec, src2, target, AS_OF, sweep=True)
    rows = [(i + 1, *r.row()[:-1]) for i, r in enumerate((r1, r2))]
    return spark.createDataFrame(rows, "run int, table_name string, strategy string, extracted long, "
                                       "inserted long, updated long, saved long, removed long, "
                                       "status string")


def partitioned_refresh(spark, d):
    """Orders in a table partitioned by order month (an immutable attribute):
    first load up to 2001-07-01, then the full source through the 60-day
    window.  The merge rewrites only the months the window touches."""
    o = tbl(spark, d, "orders")
    spec = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_orderdate")
    target = VersionedTable(spark, scratch_path(spark, "partitioned_orders"), partition_col="o_orderdate")
    r1 = ingest(spec, o.where(F.col("o_orderdate") < ts("2001-07-01 00:00:00")), target, AS_OF)
    parts1 = len(target.manifest()["parts"])
    r2 = ingest(spec, o, target, AS_OF)
    m = target.manifest()
    rewritten = sum(1 for v in m["parts"].values() if v["v"] == m["version"])
    rows = [(1, r1.strategy, r1.extracted, r1.inserted, r1.updated, r1.saved, parts1, parts1),
            (2, r2.strategy, r2.extracted, r2.inserted, r2.updated, r2.saved, len(m["parts"]), rewritten)]
    return spark.createDataFrame(rows, "run int, strategy string, extracted long, inserted long, updated long, "
                                       "saved long, partitions long, partitions_rewritten long")


# Load instants and the change of the second source of the content queries.
FIRST_AS_OF = "2001-07-01 00:00:00"
MOVED_SINCE = "2001-06-10 00:00:00"


def _second_source(spark, d, moved: bool):
    """Orders with lines only; those of the window have another priority and, if
    ``moved``, the latest ones a later date."""
    o = tbl(spark, d, "orders").join(_universe(spark, d), "o_orderkey", "left_semi")
    late = F.col("o_orderdate") >= ts(MOVED_SINCE)
    if moved:
        o = o.withColumn("o_orderdate", F.when(late, F.col("o_orderdate") + F.expr("INTERVAL 31 DAYS")).otherwise(F.col("o_orderdate")))
    window = F.col("o_orderdate") >= ts(AS_OF) - F.expr(f"INTERVAL {LOOKBACK_DAYS} DAYS")
    return o.withColumn("o_orderpriority", F.when(window, F.concat(F.lit("X-"), "o_orderpriority")).otherwise(F.col("o_orderpriority")))


def refresh_content(spark, d):
    """The table after a first load, a window merge and a sweep (SRC-07, SNK-01/04/07,
    MRG-04/06): rows of the window as the second source has them, stamped by the
    second load; keys that left the source gone; all else as first loaded."""
    spec = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_orderdate",
                     company_col="o_orderstatus", company_values=("F", "O", "P"))
    target = VersionedTable(spark, scratch_path(spark, "refresh_content"))
    ingest(spec, tbl(spark, d, "orders"), target, FIRST_AS_OF)
    ingest(spec, _second_source(spark, d, False), target, AS_OF, sweep=True)
    return target.read()


def partitioned_content(spark, d):
    """As ``refresh_content`` on a table partitioned by order month, where rows of
    the window have moved to another month meanwhile."""
    spec = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_orderdate")
    target = VersionedTable(spark, scratch_path(spark, "partitioned_content"), partition_col="o_orderdate")
    ingest(spec, tbl(spark, d, "orders"), target, FIRST_AS_OF)
    ingest(spec, _second_source(spark, d, True), target, AS_OF, sweep=True)
    return target.read()


def stream_content(spark, d):
    """Two deliveries with repeated keys through the stream (STR-01): the table it
    leaves, which is that of the batch path on the same deliveries."""
    o = tbl(spark, d, "orders")
    again = o.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    early = o.withColumn("o_orderdate", F.col("o_orderdate") - F.expr("INTERVAL 1 DAYS")).where(F.col("o_orderstatus") == "P")
    root = scratch_path(spark, "stream_content")
    spec = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_orderdate")
    target = VersionedTable(spark, f"{root}/table")
    for k, delivery in enumerate((o.unionByName(early), again)):
        delivery.write.parquet(f"{root}/in/{k}")
        incremental_ingest(spark, spec, f"{root}/in", o.schema, target, AS_OF, f"{root}/checkpoint")
    return target.read()


def stream_late(spark, d):
    """Deliveries out of order (STR-01): the newer states first, then a late file with the
    older ones and orders not seen before, then the first file once more.  The newest
    state of every order stays."""
    o = tbl(spark, d, "orders")
    newer = o.withColumns({"o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 10 DAYS"), "o_orderpriority": F.concat(F.lit("N-"), "o_orderpriority")})
    some = F.col("o_orderstatus") == "F"
    root = scratch_path(spark, "stream_late")
    spec = TableSpec(name="orders", keys=("o_orderkey",), audit_col="o_orderdate")
    target = VersionedTable(spark, f"{root}/table")
    for n, delivery in enumerate((newer.where(some), o, newer.where(some), o.where(~some).unionByName(newer.where(F.col("o_orderstatus") == "P")))):
        delivery.write.parquet(f"{root}/in/{n}")
        incremental_ingest(spark, spec, f"{root}/in", o.schema, target, AS_OF, f"{root}/checkpoint", newest_wins=True)
    return target.read()


def keyless_content(spark, d):
    """A table without keys is replaced as a whole (SRC-08): the second snapshot, not the first."""
    spec = TableSpec(name="suppliers", keys=None)
    target = VersionedTable(spark, scratch_path(spark, "keyless_content"))
    s = tbl(spark, d, "supplier")
    ingest(spec, s, target, FIRST_AS_OF)
    ingest(spec, s.where(F.col("s_nationkey") % 2 == 0).withColumn("s_acctbal", F.col("s_acctbal") + 1), target, AS_OF)
    return target.read()


def empty_batch_content(spark, d):
    """A refresh that reads nothing keeps the rows and their load stamp (SNK-02)."""
    target = VersionedTable(spark, scratch_path(spark, "empty_batch"))
    c = tbl(spark, d, "customer")
    for source, as_of in ((c, FIRST_AS_OF), (c.where(F.col("c_custkey") < 0), AS_OF)):
        ingest(TableSpec(name="customer", keys=None), source, target, as_of)
    return target.read()


def load_statuses(spark, d):
    """One run over five tables (SNK-06, SNK-08): keys that repeat make a load DIVERGENT, a
    table that fails leaves the others alone, an empty source keeps what is there."""
    o, li, c, s = (tbl(spark, d, n) for n in ("orders", "lineitem", "customer", "supplier"))
    root = scratch_path(spark, "load_statuses")
    kept = VersionedTable(spark, f"{root}/kept")
    ingest(TableSpec(name="kept", keys=("c_custkey",)), c, kept, FIRST_AS_OF)

    def failing():
        raise OSError("the source does not answer")

    jobs = [(TableSpec(name="orders", keys=("o_orderkey",)), o, VersionedTable(spark, f"{root}/orders")),
            (TableSpec(name="lineitem", keys=("l_orderkey",), audit_col="l_shipdate"), li, VersionedTable(spark, f"{root}/lineitem")),
            (TableSpec(name="broken", keys=("k",)), failing, VersionedTable(spark, f"{root}/broken")),
            (TableSpec(name="kept", keys=("c_custkey",)), c.where(F.col("c_custkey") < 0), kept),
            (TableSpec(name="view", keys=None), s, VersionedTable(spark, f"{root}/view"))]
    return run_tables(spark, jobs, AS_OF, parallelism=3).drop("seconds")


def drift_align(spark, d):
    o = tbl(spark, d, "orders")
    cut = ts("2000-01-01 00:00:00")
    old = o.where(F.col("o_orderdate") < cut).drop("o_orderpriority")
    new = o.where(F.col("o_orderdate") >= cut).withColumn("o_year", F.year("o_orderdate"))
    return S.union_drift(old, new)


# ---------------------------------------------------------------------------
# Projections, predicates (PRJ, FIL)
# ---------------------------------------------------------------------------
PART_RENAME = {"p_partkey": "product_id", "p_name": "product_name", "p_brand": "brand",
               "p_type": "type", "p_size": "size", "p_retailprice": "price", "p_comment": "note"}
TYPE_LABELS = {"ECONOMY": "Economy", "SMALL": "Small", "LARGE": "Large", "PROMO": "Promo"}


def drift_types(spark, d):
    """What each drift policy does with each pair of old and new column type (SNK-09),
    and how many values the old type would change."""
    key = F.col("o_orderkey")
    batch = tbl(spark, d, "orders").select(
        key.alias("grow"), key.cast("int").alias("keep"), F.col("o_totalprice").alias("money"),
        F.col("o_totalprice").cast("decimal(12,4)").alias("cents"), F.col("o_orderdate").alias("day"),
        (key + F.when(key % 3 == 0, 0.5).otherwise(0.0)).alias("half"), F.col("o_custkey").cast("string").alias("code"),
        F.col("o_orderpriority").alias("word"), key.alias("text"), F.col("o_orderstatus").alias("more"))
    old = T.StructType.fromDDL("grow int, keep bigint, money decimal(10,2), cents decimal(8,2), day date, half bigint, code bigint, "
                               "word int, text string, gone string")
    out = None
    for policy in DR.POLICIES:
        one = DR.drift_report(batch, old, policy).select(F.lit(policy).alias("policy"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def project_rename(spark, d):
    p = sheets.rename_present(tbl(spark, d, "part"), PART_RENAME)
    p = p.toDF(*[c.strip().upper() for c in p.columns])
    p = p.withColumns({c: F.trim(F.col(c)) for c, t in p.dtypes if t == "string"})
    label = F.when(F.lit(False), None)
    for k, v in TYPE_LABELS.items():
        label = label.when(F.col("TYPE") == k, v)
    label = label.otherwise("Other")
    size_class = (F.when(F.col("SIZE") <= 10, "S").when(F.col("SIZE") <= 30, "M").otherwise("L"))
    return (p.withColumn("TYPE_LABEL", label).withColumn("SIZE_CLASS", size_class)
             .drop("TYPE")
             .select("PRODUCT_ID", "PRODUCT_NAME", "BRAND", "TYPE_LABEL", "SIZE", "SIZE_CLASS", "PRICE"))


def predicate_mix(spark, d):
    li = tbl(spark, d, "lineitem")
    o = tbl(spark, d, "orders").where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("l_orderkey"))
    big = tbl(spark, d, "part").where(F.col("p_size") > 45).select(F.col("p_partkey").alias("l_partkey"))
    cut = ts("2000-06-01 00:00:00")
    pairs = (((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"))
             | ((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")))
    key_text = F.col("l_partkey").cast("string")
    f = (li.where((F.col("l_shipdate") >= cut) & pairs & (key_text > "1000") & (key_text < "1500"))
           .join(o, "l_orderkey", "left_semi")
           .join(big, "l_partkey", "left_anti"))
    return f.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                    (F.col("l_shipdate") > cut).alias("strict_after"),
                    (F.date_format("l_shipdate", "yyyyMMdd") > "20000601").alias("text_after"),
                    (F.col("l_returnflag").isNotNull() & (F.col("l_returnflag") != X.BLANK)).alias("has_flag"))


# ---------------------------------------------------------------------------
# Joins (JON)
# ---------------------------------------------------------------------------
def star_enrichment(spark, d):
    li, o = tbl(spark, d, "lineitem"), tbl(spark, d, "orders")
    c, s = tbl(spark, d, "customer"), tbl(spark, d, "supplier")
    nation, region = tbl(spark, d, "nation"), tbl(spark, d, "region")
    cn = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("cust_nation"),
                       F.col("n_regionkey").alias("_cr"))
    sn = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supp_nation"),
                       F.col("n_regionkey").alias("_sr"))
    cr = region.select(F.col("r_regionkey").alias("_cr"), F.col("r_name").alias("cust_region"))
    sr = region.select(F.col("r_regionkey").alias("_sr"), F.col("r_name").alias("supp_region"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
           .join(c, F.col("o_custkey") == c.c_custkey, "left")
           .join(cn, "c_nationkey", "left").join(cr, "_cr", "left")
           .join(s, li.l_suppkey == s.s_suppkey, "left")
           .join(sn, "s_nationkey", "left").join(sr, "_sr", "left"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                    "l_extendedprice", "o_orderdate", "o_orderstatus", "c_name", "cust_nation",
                    "cust_region", "s_name", "supp_nation", "supp_region")


def heavy_key_join(spark, d):
    """Lines joined to suppliers by a serial of which one holds a third of the lines; lines
    with a blank or missing serial bypass the join (JON-01)."""
    n = F.col("l_linenumber")
    serial = (F.when(n == 6, F.lit(None)).when(n == 5, F.lit(" ")).when(F.col("l_orderkey") % 3 == 0, F.lit("1"))
              .otherwise(F.col("l_suppkey").cast("string")))
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", serial.alias("serial"))
    s = tbl(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("serial"), "s_name", "s_nationkey")
    return HK.heavy_left_join(li, s, ["serial"], empty=(" ",))


def inner_chain(spark, d):
    li, o, c = tbl(spark, d, "lineitem"), tbl(spark, d, "orders"), tbl(spark, d, "customer")
    n = tbl(spark, d, "nation")
    j = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
           .join(c, F.col("o_custkey") == c.c_custkey, "left")
           .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
           .where(F.col("n_regionkey") == 1))          # right-side filter: inner in effect
    return j.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate", "c_name", "n_name")


def keyed_expression_join(spark, d):
    c = tbl(spark, d, "customer")
    base = c.groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_custkey").alias("_base"))
    cb = c.join(base, ["c_nationkey", "c_mktsegment"], "left").withColumn(
        "group_base", F.when(F.col("_base") == F.col("c_custkey"), F.lit(None).cast("long"))
        .otherwise(F.col("_base")))
    b = c.select(F.col("c_custkey").alias("_bk"), F.col("c_name").alias("base_name"))
    n = tbl(spark, d, "nation").where(F.col("n_regionkey") == 2).select(
        F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("region2_nation"))
    owners = c.select(F.lower("c_mktsegment").alias("_seg")).distinct().withColumn(
        "owner_code", F.upper(F.substring("_seg", 1, 3)))
    j = (cb.join(b, F.coalesce(F.col("group_base"), F.col("c_custkey")) == F.col("_bk"), "left")
           .join(n, F.col("c_nationkey") == F.col("_nk"), "left")
           .join(owners, F.lower(F.col("c_mktsegment")) == F.col("_seg"), "left"))
    return j.select("c_custkey", "group_base", "base_name", "region2_nation", "owner_code")


def aggregate_join(spark, d):
    """Lines with their order total and same-day total (JON-14/15).

    Both totals come from one (order, day) pre-aggregate; the per-order total
    is a window over that aggregate (a group holds one row per shipping day of
    the order, so a hot order stays small).  The line table is joined once.
    """
    li = tbl(spark, d, "lineitem").withColumn("ship_day", F.to_date("l_shipdate"))
    per_day = li.groupBy("l_orderkey", "ship_day").agg(F.sum(X.money(li, "l_quantity")).alias("_dq"))
    totals = per_day.withColumn("_oq", F.sum("_dq").over(Window.partitionBy("l_orderkey")))
    j = li.join(totals, ["l_orderkey", "ship_day"], "left")
    return j.select("l_orderkey", "l_linenumber", "ship_day", "l_quantity",
                    F.col("_oq").cast("double").alias("order_qty"),
                    F.col("_dq").cast("double").alias("same_day_qty"))


def interval_rate(spark, d):
    o, li = tbl(spark, d, "orders"), tbl(spark, d, "lineitem")
    q0 = F.trunc("o_orderdate", "quarter")
    y0 = F.trunc("o_orderdate", "year")
    quarterly = (o.groupBy(F.col("o_orderstatus").alias("centre"), q0.alias("d0"))
                  .agg(F.count(F.lit(1)).alias("rate"))
                  .withColumn("d1", F.date_sub(F.add_months("d0", 3), 1)))
    yearly = (o.groupBy(F.col("o_orderstatus").alias("centre"), y0.alias("d0"))
               .agg(F.countDistinct("o_custkey").alias("rate"))
               .withColumn("d1", F.date_sub(F.add_months("d0", 12), 1)))
    rates = quarterly.unionByName(yearly)
    readings = li.withColumn("centre", F.col("l_linestatus"))
    j = I.interval_rate(readings, rates, "centre", F.col("l_shipdate"), "d0", "d1", "rate")
    return j.select("l_orderkey", "l_linenumber", "l_linestatus",
                    F.to_date("l_shipdate").alias("ship_day"),
                    F.col("rate").cast("double").alias("rate"),
                    (F.col("l_quantity") * F.col("rate").cast("double")).alias("cost"))


def interval_rate_long(spark, d):
    """Intervals of fifty years that start and end within a day, one an order; half of
    the readings are taken as long after."""
    o, li = tbl(spark, d, "orders"), tbl(spark, d, "lineitem")
    start = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_custkey") % 86400).cast("decimal(18,6)"))
    rates = o.select(F.col("o_orderstatus").alias("l_linestatus"), start.alias("t0"), "o_totalprice").withColumn(
        "t1", F.when(F.col("o_totalprice") > 100000, ts("9999-12-31 00:00:00")).otherwise(F.col("t0") + F.expr("INTERVAL 50 YEARS")))
    moment = F.col("l_shipdate") + F.make_dt_interval(secs=(F.col("l_partkey") % 86400).cast("decimal(18,6)"))
    readings = li.select("l_orderkey", "l_linenumber", "l_linestatus",
                         F.when(F.col("l_linenumber") % 2 == 0, moment + F.expr("INTERVAL 50 YEARS")).otherwise(moment).alias("read_at"))
    j = I.interval_rate(readings, rates, "l_linestatus", F.col("read_at"), "t0", "t1", "o_totalprice")
    return j.withColumn("rate", F.col("rate").cast("double"))


def lookup_exact_or_latest(spark, d):
    ev = tbl(spark, d, "events")
    purchases = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = ev.where(F.col("event_type") == "view")
    return B.lookup_exact_or_latest(purchases, views, "user_id", F.to_date("ts"),
                                    F.to_date(views.ts), views.ts, "view_ts")


def lookup_reach(spark, d):
    ev = tbl(spark, d, "events")
    business_cut, reach_cut = ts("2024-01-15 00:00:00"), ts("2024-01-08 00:00:00")
    purchases = ev.where((F.col("event_type") == "purchase") & (F.col("ts") >= business_cut))
    views = (ev.where((F.col("event_type") == "view") & (F.col("ts") >= reach_cut))
               .groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"), F.max("value").alias("max_view_value")))
    j = purchases.join(views, "user_id", "left")
    return j.select("event_id", "user_id", "ts", "value",
                    F.coalesce("_n", F.lit(0)).alias("views_in_reach"), "max_view_value")


def scalar_lookup_avg(spark, d):
    o, li = tbl(spark, d, "orders"), tbl(spark, d, "lineitem")
    # the fan-out of the join, computed before it: lines combine per order first
    lines = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(X.money(li, "l_quantity")).alias("_q"))
    per_order = o.join(lines, o.o_orderkey == lines.l_orderkey, "inner").select(
        "o_orderkey", "o_orderdate", "n_lines", "_q",
        (X.money(o, "o_totalprice").cast("decimal(24,6)") * F.col("n_lines").cast("decimal(10,0)")).alias("_t"))
    per_order = B.attach_month_total(per_order, [], "o_orderdate", "_q", "_mq")
    return per_order.select(
        "o_orderkey", "o_orderdate", "n_lines", F.col("_q").cast("double").alias("sum_qty"),
        (F.col("_t").cast("double") / F.col("n_lines")).alias("avg_total"),
        F.col("_mq").cast("double").alias("month_qty"))


def sheet_enrich(spark, d):
    """Mix sheet derived from part, written as CSV to the shared folder, read back
    typed and left-joined; a part listed twice fans out (JON-16)."""
    p = tbl(spark, d, "part")
    sheet_rows = (p.where(F.col("p_size") <= 5)
                   .select(F.col("p_partkey").alias("Cd_Item"), F.col("p_brand").alias("Cd_Com_Mix"),
                           F.col("p_type").alias("Cd_Com_Ori"))
                   .unionByName(p.where((F.col("p_type") == "SMALL") & (F.col("p_size") <= 5))
                                .select(F.col("p_partkey").alias("Cd_Item"),
                                        F.concat(F.lit("MIX-"), "p_type").alias("Cd_Com_Mix"),
                                        F.lit("EXTRA").alias("Cd_Com_Ori"))))
    path = scratch_path(spark, "mix_sheet")
    sheet_rows.write.mode("overwrite").csv(path, header=True)
    schema = T.StructType([T.StructField("Cd_Item", T.LongType()), T.StructField("Cd_Com_Mix", T.StringType()),
                           T.StructField("Cd_Com_Ori", T.StringType())])
    sheet = sheets.read_sheet_or_nulls(spark, path, schema)
    sheet = sheets.rename_present(sheet, {"Cd_Item": "p_partkey", "Cd_Com_Mix": "MIX", "Cd_Com_Ori": "ORIGEM"})
    out = sheets.enrich_or_null(p, sheet, ["p_partkey"], {"MIX": T.StringType(), "ORIGEM": T.StringType()})
    return out.select("p_partkey", "p_name", "MIX", "ORIGEM")


# ---------------------------------------------------------------------------
# Aggregations and windows (AGG, WIN)
# ---------------------------------------------------------------------------
def nth_purchase(spark, d):
    return B.nth_event(tbl(spark, d, "orders"), "o_custkey", "o_orderdate", 4,
                       ["first_purchase", "second_purchase", "third_purchase", "fourth_purchase"],
                       "last_purchase", "n_purchase_days")


def first_last_by(spark, d):
    return B.first_last_by(tbl(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"],
                           "o_orderpriority", "first_priority", "last_priority")


def allocate_share(spark, d):
    li, o = tbl(spark, d, "lineitem"), tbl(spark, d, "orders")
    counts = B.line_counts(li, "l_orderkey")                 # all lines, before the filter
    lines = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")
    j = B.allocate_share(lines, counts, "l_orderkey", F.col("o_totalprice")).where(
        F.col("l_linestatus") == "O")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "n_lines", "share",
                    (F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("share")).alias("net_value"))


BILLING_COLUMNS = [("block_tag", "string"), ("l_orderkey", "bigint"), ("l_linenumber", "int"),
                   ("item_key", "string"), ("qty", "double"), ("gross_value", "double"),
                   ("tax_value", "double"), ("net_value", "double"), ("event_date", "timestamp_ntz")]


def billing_blocks(li: DataFrame, o: DataFrame) -> DataFrame:
    """Four blocks of different nature, one typed shape, tagged (SET-01).

    One pass over the lines: a line gets the tags of every block it belongs to
    (open-order line, and sale / service / return by its flag), the tags are
    exploded and each output column is chosen per tag.  The lines are read
    once instead of once per block.

    Returns are negated as ``0 - x`` (never ``-x``) so a zero stays +0.0: set
    operations normalise -0.0 and the two versions must compare equal.
    """
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    tax = F.col("l_extendedprice") * F.col("l_tax")
    flag = F.col("l_returnflag")
    open_orders = o.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_orderdate")
    tags = F.array(F.when(F.col("o_orderkey").isNotNull(), F.lit("PED")),
                   F.when(flag == "N", "VEN").when(flag == "A", "SER").when(flag == "R", "DEV"))
    x = (li.join(open_orders, li.l_orderkey == open_orders.o_orderkey, "left")
           .select("*", F.explode(tags).alias("block_tag"))
           .where(F.col("block_tag").isNotNull()))
    tag = F.col("block_tag")

    def by_tag(ped, ven, ser, dev):
        return F.when(tag == "PED", ped).when(tag == "VEN", ven).when(tag == "SER", ser).otherwise(dev)

    none = F.lit(None)
    blocks = x.select(
        "block_tag", "l_orderkey", "l_linenumber",
        by_tag(X.oconcat("l_orderkey", F.lit("-"), "l_linenumber"), X.oconcat("l_partkey", F.lit("/"), "l_suppkey"),
               X.oconcat(F.lit("S"), "l_partkey"),
               X.oconcat("l_partkey", F.lit("/"), "l_suppkey", F.lit("/R"))).alias("item_key"),
        by_tag(F.col("l_quantity"), F.col("l_quantity"), F.col("l_quantity"), 0 - F.col("l_quantity")).alias("qty"),
        by_tag(F.col("l_extendedprice"), F.col("l_extendedprice"), F.col("l_extendedprice"),
               0 - F.col("l_extendedprice")).alias("gross_value"),
        by_tag(none, tax, none, 0 - tax).alias("tax_value"),
        by_tag(net, net + tax, net, 0 - net).alias("net_value"),
        by_tag(F.col("o_orderdate"), F.col("l_shipdate"), F.col("l_shipdate"), F.col("l_shipdate")).alias("event_date"))
    return B.union_blocks([blocks], BILLING_COLUMNS)


def billing_union(spark, d):
    return billing_blocks(tbl(spark, d, "lineitem"), tbl(spark, d, "orders"))


def unit_scaling(spark, d):
    p = tbl(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_size") <= 10, "D").when(F.col("p_size") <= 30, "H")
        .when(F.col("p_size") <= 45, "M").otherwise("S").alias("unit"))
    li = tbl(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity",
                                          "l_extendedprice")
    r = B.scaled_sum(li.join(p, "p_partkey"), "p_partkey", "l_quantity", "unit",
                     other_col="l_extendedprice")
    return r.select("p_partkey", "unit", F.col("sum_value").cast("double").alias("sum_value"),
                    "minutes", "product")


def full_outer_budget(spark, d):
    o, li = tbl(spark, d, "orders"), tbl(spark, d, "lineitem")
    budget = (o.groupBy(X.month_start("o_orderdate").alias("b_month"))
               .agg(F.sum(X.money(o, "o_totalprice")).alias("_b")))
    actual = (li.groupBy(X.month_start("l_shipdate").alias("a_month"))
                .agg(F.sum(X.money(li, "l_extendedprice")).alias("_a")))
    j = budget.join(actual, F.col("b_month") == F.col("a_month"), "full").where(
        F.col("b_month").isNotNull())                     # WHERE on the left: left join in effect
    return j.select(F.col("b_month").alias("month_start"), F.year("b_month").alias("year"),
                    X.quarter_label("b_month").alias("quarter_label"),
                    F.col("_b").cast("double").alias("budget"), F.col("_a").cast("double").alias("actual"))


def trailing_months(spark, d):
    # history older than 6 months before the cutoff can never reach a kept
    # month: filtered at the scan, the window result is unchanged
    m = B.monthly_sum(tbl(spark, d, "lineitem"), "l_partkey", "l_shipdate", "l_quantity",
                      since=B.window_floor("2000-01-01", 6))
    r = B.trailing_months(m, "l_partkey", "month_start", "qty", back=6, skip=1,
                          out="qty_6m", cutoff="2000-01-01")
    return r.select(
        "l_partkey", "month_start", F.last_day("month_start").alias("month_end"),
        F.add_months("month_start", -6).alias("window_start"),
        F.last_day(F.add_months("month_start", -1)).alias("window_end"),
        F.col("qty").cast("double").alias("qty"), F.col("qty_6m").cast("double").alias("qty_6m"),
        F.concat_ws("|", X.month_key("month_start"), F.col("l_partkey").cast("string")).alias("month_key"))


def trailing_refresh(spark, d):
    """The trailing months of the line items, kept from before a merge and brought up to
    date by what it changed: rows that move to other months, that are new and that go."""
    li = tbl(spark, d, "lineitem")
    odd = F.col("l_orderkey") % 50
    before = li.where(odd != 7)
    removed = before.where((odd == 0) | (odd == 13))
    moved = before.where(odd == 0).withColumns({"l_shipdate": F.col("l_shipdate") + F.expr("INTERVAL 40 DAYS"), "l_quantity": F.col("l_quantity") + 1})
    added = moved.unionByName(li.where(odd == 7))
    keys = ["l_suppkey"]
    state = RO.monthly_state(before, keys, "l_shipdate", "l_quantity")
    trailing = B.trailing_months(state.select(*keys, "month_start", "qty"), keys, "month_start", "qty", back=6, skip=1)
    change = RO.monthly_change(removed, added, keys, "l_shipdate", "l_quantity")
    state = RO.apply_change(state, change, keys)
    now = RO.refresh_trailing(trailing, state, change, keys, back=6, skip=1)
    return now.withColumns({c: F.col(c).cast("double") for c in ("qty", "trailing")})


def balanced_ranges(spark, d):
    """A skewed key read by balanced ranges (SRC-11, SRC-12): how many rows the ranges read
    in all, how many rows fell into none or several, and whether no range with more than
    one key reads over twice its share."""
    li = tbl(spark, d, "lineitem")
    skewed = li.select(F.when(F.col("l_linenumber") == 1, F.lit(5)).when(F.col("l_linenumber") == 2, F.lit(None))
                       .otherwise(F.col("l_orderkey") * F.col("l_orderkey")).cast("long").alias("k"))
    ranges = 16
    tests = [F.coalesce(F.expr(p), F.lit(False)) for p in RG.balanced_predicates(skewed, "k", ranges)]
    hits = F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(tests)])
    placed = skewed.select("k", F.array_compact(hits).alias("at")).select("k", F.explode_outer("at").alias("part"), F.size("at").alias("hits"))
    n, part = F.count(F.lit(1)), F.col("part")
    each = placed.groupBy("part").agg(n.alias("n"), F.countDistinct("k").alias("n_keys"), F.count_if(F.col("hits") > 1).alias("several"), F.count("k").alias("keyed"))
    wide = F.max(F.when((F.col("n_keys") > 1) & (part > 0), F.col("n")))
    none = F.coalesce(F.sum(F.when(part.isNull(), F.col("n"))), F.lit(0))
    return each.agg(F.sum(F.when(part.isNotNull(), F.col("n"))).alias("n_read"), none.alias("in_none"), F.sum("several").alias("in_several"),
                    (wide * ranges <= 2 * F.sum("keyed")).alias("balanced"))


def previous_event(spark, d):
    p = B.previous_event(tbl(spark, d, "events"), "user_id", "ts")
    serial = F.col("user_id").cast("string")
    return p.where(F.col("day") > F.lit("2024-01-05").cast("date")).select(   # strict cutoff after LAG
        "user_id", "day", "prev_day",
        X.repeat_days(serial, "day", "prev_day").alias("days_since"),
        X.repeat_class(serial, "day", "prev_day", limit_days=3).alias("repeat_class"))


def signed_sum(spark, d):
    li = tbl(spark, d, "lineitem")
    g = li.groupBy("l_returnflag", F.year("l_shipdate").alias("ship_year")).agg(
        F.sum(X.signed(X.money(li, "l_quantity"), "l_linestatus", "F")).cast("double").alias("signed_qty"),
        F.count(F.lit(1)).alias("n_rows"))
    return g.orderBy(X.asc("l_returnflag"), X.asc("ship_year"))         # SRT-01, cosmetic


# ---------------------------------------------------------------------------
# Scalar functions (SCA)
# ---------------------------------------------------------------------------
def text_clean(spark, d):
    c = tbl(spark, d, "customer")
    ptype = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "J").otherwise("F")
    return c.select(
        "c_custkey", X.trim_upper("c_name").alias("name_upper"), X.trim_lower("c_name").alias("name_lower"),
        ptype.alias("person_type"), X.tax_id("c_custkey", ptype).alias("tax_id"),
        X.lpad_num("c_nationkey", 8).alias("postal_code"), X.digits_only("c_name").alias("digits"),
        F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")).alias("display_name"),
        X.fm00("c_nationkey").alias("nation_code"), X.blank_to_null("c_mktsegment").alias("segment_clean"),
        X.full_address("c_name", "c_custkey", "c_mktsegment").alias("address"))


def sheet_clean(spark, d):
    lab = tbl(spark, d, "labels")
    sheet = lab.select(*[F.col(c).cast("string").alias(c) for c in lab.columns])
    sheet = sheet.toDF(*[c.strip().upper() for c in sheet.columns])
    sheet = sheet.select(*[F.trim(F.col(c)).alias(c) for c in sheet.columns])
    sheet = sheets.required(sheet, ["DOC_ID", "QUALITY"]).withColumn("KEY", F.concat_ws("|", "DOC_ID", "QUALITY"))
    sheet = sheet.where(~sheets.separator_only("KEY"))
    docs = tbl(spark, d, "documents").select(F.col("doc_id").cast("string").alias("DOC_ID"),
                                             F.col("lang").alias("LANG"))
    out = sheet.join(docs, "DOC_ID", "left")
    return out.select("DOC_ID", "QUALITY", "TOXIC", "LANG", "KEY",
                      X.locale_decimal("QUALITY").alias("QUALITY_NUM"))


def sheet_rejects(spark, d):
    """Supplier sheets, one file a nation, written with values that do not parse and lines
    that are cut short, and read back as typed rows and rejects (SRC-13, SRC-14)."""
    s, key = tbl(spark, d, "supplier"), F.col("s_suppkey")
    money = (F.when(key % 5 == 0, "n/a").when(key % 7 == 0, "").otherwise(F.col("s_acctbal").cast("decimal(12,2)").cast("string")))
    value = F.when(key % 11 == 0, F.concat(key.cast("string"), F.lit(",cut"))).otherwise(
        F.concat(key.cast("string"), F.lit(', "'), F.col("s_name"), F.lit(', Ltd" ,'), money))
    lines = s.select(F.col("s_nationkey").alias("nation"), key.alias("at"), value.alias("value"))
    head = s.select(F.col("s_nationkey").alias("nation"), F.lit(-1).cast("long").alias("at"), F.lit(" s_suppkey,Name,Balance").alias("value")).distinct()
    path = scratch_path(spark, "supplier_sheets")
    lines.unionByName(head).repartition("nation").sortWithinPartitions("nation", "at").select("nation", "value").write.partitionBy("nation").text(path)
    sheet = sheets.read_checked_sheet(spark, path, T.StructType.fromDDL("balance decimal(12,2), s_suppkey bigint, name string"))

    def nation(c):
        return F.regexp_extract(c, "nation=([0-9]+)", 1).cast("int").alias("nation")
    rows = sheet.rows.select(nation("_file"), F.col("_line").alias("line"), F.lit("row").alias("kind"), F.lit(None).cast("string").alias("column"),
                             F.lit(None).cast("string").alias("text"), "s_suppkey", "name", F.col("balance").cast("double").alias("balance"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("s_suppkey", "long"), ("name", "string"), ("balance", "double"))]
    return rows.unionByName(sheet.rejects.select(nation("file"), "line", F.lit("reject").alias("kind"), "column", "text", *none))


def dates_text(spark, d):
    o = tbl(spark, d, "orders")
    return o.select(
        "o_orderkey", X.day("o_orderdate").alias("order_day"), X.month_start("o_orderdate").alias("order_month"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("order_text"),
        F.date_format("o_orderdate", "MM/yyyy").alias("month_text"),
        X.same_month("o_orderdate", ts(AS_OF)).alias("same_month_as_of"),
        X.when_in("o_orderstatus", ["F"], X.day("o_orderdate")).alias("closed_day"))


def int_text(spark, d):
    p = tbl(spark, d, "part")
    raw = (F.when(F.col("p_size") < 25, F.col("p_retailprice").cast("string"))
           .when(F.col("p_size") < 40, F.col("p_brand")))
    return p.select("p_partkey", raw.alias("code_raw")).withColumn("code", X.int_text("code_raw"))


REGION_MACRO = {"AFRICA": "South", "AMERICA": "West", "ASIA": "East", "EUROPE": "North"}


def map_flags(spark, d):
    c = tbl(spark, d, "customer")
    n = tbl(spark, d, "nation")
    r = tbl(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    return j.select(
        "c_custkey", X.map_lookup("r_name", REGION_MACRO).alias("macro_region"),
        X.member_flag("c_nationkey", range(5), "Nacional", "Importado").alias("origin_class"),
        X.space_default("c_mktsegment", F.lit("NONE")).alias("segment_or_default"),
        X.pipe_key("c_custkey", "c_nationkey", "c_mktsegment").alias("rel_key"))


def sla_status(spark, d):
    o, li = tbl(spark, d, "orders"), tbl(spark, d, "lineitem")
    per = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))).alias("finish"),
        F.max("l_shipdate").alias("delivered"))
    carrier = (F.when(F.col("o_orderpriority") == "1-URGENT", X.TRANSPORT_POSTAL)
               .when(F.col("o_orderpriority") == "2-HIGH", X.TRANSPORT_PICKUP)
               .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
               .otherwise(F.col("o_orderpriority")))
    j = o.join(per, "o_orderkey", "left").withColumn("carrier", carrier)
    return j.select(
        "o_orderkey", X.sla_status("o_orderdate", "finish", AS_OF).alias("sla_status"),
        X.sla_days("o_orderdate", "finish", AS_OF).alias("sla_days"),
        X.delivery_days("delivered", "o_orderdate").alias("delivery_days"),
        X.delivery_bucket("delivered", "o_orderdate").alias("delivery_bucket"),
        X.finish_year_text("finish").alias("finish_year"), F.month("finish").alias("finish_month"),
        F.dayofmonth("finish").alias("finish_day"), X.transport_type("carrier").alias("transport_type"),
        X.delivery_carrier("carrier").alias("delivery_carrier"))


# ---------------------------------------------------------------------------
# Reconciliation (REC, SET)
# ---------------------------------------------------------------------------
def _orders_b(spark, d):
    """Second version of orders: lost the orders without lines, a changed
    priority on 2001 pending orders, and early orders delivered twice."""
    o, lines = tbl(spark, d, "orders"), _universe(spark, d)
    n = R.tasks_for(spark, lines.count())
    b = o.repartition(n, "o_orderkey").join(lines.repartition(n, "o_orderkey"), "o_orderkey", "left_semi").withColumn(
        "o_orderpriority",
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") >= ts("2001-01-01 00:00:00")),
               "3-MEDIUM").otherwise(F.col("o_orderpriority")))
    dup = b.where(F.col("o_orderdate") < ts("1995-02-01 00:00:00"))
    return b.unionByName(dup)


def content_diff(spark, d):
    return R.symmetric_diff(tbl(spark, d, "orders"), _orders_b(spark, d))


def diff_sample(spark, d):
    """The first 10 differing rows in a total order: the reconciliation sample
    printed for a human (SRT-02); the full difference stays distributed."""
    return R.sample(content_diff(spark, d), ["o_orderkey", "side"], 10)


def content_diff_strict(spark, d):
    return R.symmetric_diff(tbl(spark, d, "orders"), _orders_b(spark, d), strict=True)


def digest_diff(spark, d):
    """The differences of ``content_diff`` by digests of key ranges: rows of equal ranges
    are not shuffled."""
    return D.digest_diff(tbl(spark, d, "orders"), _orders_b(spark, d), ["o_orderkey"])


def digest_diff_strict(spark, d):
    """Line items against a version that lost, changed and repeated some of them."""
    li = tbl(spark, d, "lineitem")
    odd = F.col("l_orderkey") % 97 == 0
    b = li.where(~(odd & (F.col("l_returnflag") == "R"))).withColumn(
        "l_tax", F.when(odd & (F.col("l_returnflag") == "A"), F.lit(None)).otherwise(F.col("l_tax")))
    return D.digest_diff(li, b.unionByName(b.where(odd)), LINE_KEYS, strict=True)


def column_common(spark, d):
    a = tbl(spark, d, "orders").withColumn("o_year", F.year("o_orderdate"))
    b = _orders_b(spark, d).drop("o_orderpriority").withColumn("o_month", F.month("o_orderdate"))
    return R.common_columns_diff(a, b)


def superset_check(spark, d):
    fill = {"o_orderpriority": X.BLANK}
    old = R.null_normalised(tbl(spark, d, "orders"), fill)
    new = R.null_normalised(_orders_b(spark, d), fill)
    return R.one_sided_diff(old, new)


def set_diff_systems(spark, d):
    cols = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    a = tbl(spark, d, "orders")
    b = (tbl(spark, d, "orders").where(F.col("o_orderdate") < ts("2001-07-01 00:00:00"))
         .withColumn("o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", "5-LOWEST")
                     .otherwise(F.col("o_orderpriority"))))
    return R.symmetric_diff(a, b, cols)


STABLE_AS_OF = "2001-11-05 00:00:00"


def stable_diff(spark, d):
    li, o = tbl(spark, d, "lineitem"), tbl(spark, d, "orders")
    a = billing_blocks(li, o)
    b = billing_blocks(M.dedup_first(li, LINE_KEYS, order=["l_shipdate"]), o)
    ev = F.col("event_date")
    rules = {"PED": ev >= ts("2001-01-01 00:00:00"), "VEN": ev > ts("2001-01-01 00:00:00"),
             "SER": ev >= ts("2001-03-01 00:00:00"), "DEV": ev >= ts("2001-03-01 00:00:00")}
    keep = R.cutoff_rules("block_tag", rules) & R.stable_window(
        "event_date", STABLE_AS_OF, days=2, month_tags=["DEV"], tag_col="block_tag")
    return R.symmetric_diff(a.where(keep), b.where(keep))


def control_totals(spark, d):
    li = tbl(spark, d, "lineitem")
    return R.control_totals(li, M.dedup_first(li, LINE_KEYS, order=["l_shipdate"]),
                            "l_shipdate", "l_returnflag", "l_extendedprice")


def count_check(spark, d):
    o, li = tbl(spark, d, "orders"), tbl(spark, d, "lineitem")
    scope = F.col("o_orderstatus").isin("F", "O")
    a = R.count_check("orders", o, o.where(scope), scope=scope)
    b = R.count_check("lineitem", li, M.dedup_first(li, LINE_KEYS, order=["l_shipdate"]))
    return a.unionByName(b)


def count_widened(spark, d):
    c, s = tbl(spark, d, "customer"), tbl(spark, d, "supplier")
    comp = F.col("c_mktsegment") == "BUILDING"
    branch = F.col("c_nationkey") < 5
    a = R.count_check("customer", c, c.where(comp & branch), scope=comp & branch, widened_scope=comp)
    s_scope = F.col("s_nationkey") < 10
    b = R.count_check("supplier", s, s, scope=s_scope, multi_writer=True)
    return a.unionByName(b)


def keyless_count(spark, d):
    ev, conv = tbl(spark, d, "events"), tbl(spark, d, "conversations")
    scope = F.col("event_type").isin("view", "click", "purchase")
    a = R.count_check("events", ev, ev.where(scope), scope=scope)
    b = R.count_check("conversations", conv, conv.where(F.col("role").isNotNull()))
    return a.unionByName(b)


def run_summary(spark, d):
    checks = count_check(spark, d).unionByName(count_widened(spark, d)).unionByName(keyless_count(spark, d))
    return R.summary(checks)


def freshness(spark, d):
    o, li, ev = tbl(spark, d, "orders"), tbl(spark, d, "lineitem"), tbl(spark, d, "events")
    return (R.freshness("orders", o, "o_orderdate", "2001-07-31 00:00:00")
            .unionByName(R.freshness("lineitem", li, "l_shipdate", "2001-11-01 00:00:00"))
            .unionByName(R.freshness("events", ev, "ts", "2024-02-01 00:00:00")))


QUERIES = {
    "scoped_lookback": scoped_lookback,
    "lookback_fallback": lookback_fallback,
    "lookback_sentinel": lookback_sentinel,
    "override_priority": override_priority,
    "key_universe": key_universe,
    "column_profile": column_profile,
    "merged_profiles": merged_profiles,
    "multi_scope": multi_scope,
    "declared_schema": declared_schema,
    "dedup_first": dedup_first,
    "key_grain_report": key_grain_report,
    "upsert_snapshot": upsert_snapshot,
    "insert_if_absent": insert_if_absent,
    "orphan_sweep": orphan_sweep,
    "orphan_sweep_scoped": orphan_sweep_scoped,
    "range_sweep": range_sweep,
    "range_sweep_removed": range_sweep_removed,
    "tie_break_reference": tie_break_reference,
    "safe_key": safe_key,
    "full_refresh_audit": full_refresh_audit,
    "partitioned_refresh": partitioned_refresh,
    "refresh_content": refresh_content,
    "partitioned_content": partitioned_content,
    "stream_content": stream_content,
    "stream_late": stream_late,
    "keyless_content": keyless_content,
    "empty_batch_content": empty_batch_content,
    "load_statuses": load_statuses,
    "drift_align": drift_align,
    "drift_types": drift_types,
    "project_rename": project_rename,
    "predicate_mix": predicate_mix,
    "star_enrichment": star_enrichment,
    "heavy_key_join": heavy_key_join,
    "inner_chain": inner_chain,
    "keyed_expression_join": keyed_expression_join,
    "aggregate_join": aggregate_join,
    "interval_rate": interval_rate,
    "interval_rate_long": interval_rate_long,
    "lookup_exact_or_latest": lookup_exact_or_latest,
    "lookup_reach": lookup_reach,
    "scalar_lookup_avg": scalar_lookup_avg,
    "sheet_enrich": sheet_enrich,
    "nth_purchase": nth_purchase,
    "first_last_by": first_last_by,
    "allocate_share": allocate_share,
    "billing_union": billing_union,
    "unit_scaling": unit_scaling,
    "full_outer_budget": full_outer_budget,
    "trailing_months": trailing_months,
    "trailing_refresh": trailing_refresh,
    "balanced_ranges": balanced_ranges,
    "previous_event": previous_event,
    "signed_sum": signed_sum,
    "text_clean": text_clean,
    "sheet_clean": sheet_clean,
    "sheet_rejects": sheet_rejects,
    "dates_text": dates_text,
    "int_text": int_text,
    "map_flags": map_flags,
    "sla_status": sla_status,
    "content_diff": content_diff,
    "content_diff_strict": content_diff_strict,
    "diff_sample": diff_sample,
    "digest_diff": digest_diff,
    "digest_diff_strict": digest_diff_strict,
    "column_common": column_common,
    "superset_check": superset_check,
    "set_diff_systems": set_diff_systems,
    "stable_diff": stable_diff,
    "control_totals": control_totals,
    "count_check": count_check,
    "count_widened": count_widened,
    "keyless_count": keyless_count,
    "run_summary": run_summary,
    "freshness": freshness,
    **PRODUCT_QUERIES,
    **MAIN_QUERIES,
}
