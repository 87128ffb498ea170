"""Queries of the ingest path: given tables written as CSV to the shared folder and read back.

They cover the typed and inferring scan (A1), malformed rows, the load with its view of
valid rows (A4, A5), folder discovery and the profiling job (A3, L5), the CSV sink (A7),
the row cleaners (B1, B2, B5, B7, B18, B20) and surrogate row ids (E2).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.feature_store import FeatureStore
from ..operators.cleaning import default_numeric, drop_columns, keep_between, keep_positive, select_existing
from ..operators.split import with_row_id
from ..functions.scalar import safe_date
from ..session import scratch_path
from ..sources.manifest import CURRENT, read_json, replace_table
from ..sources.readers import load_table, read_csv_typed, read_table
from ..sources.sinks import write_table
from .star_queries import (_LOOKBACK_COLS, MEASURES, ORACLE, WINDOWS, anchors, cutoff_for, facts, measure_columns, r6,
                           register)
from .workflow import profile_raw


@register("csv_typed_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_typed_scan(spark, sf):
    """Orders through the CSV sink and back: the date by its stated type, the rest inferred."""
    path = write_table(read_table(spark, sf, "orders"), scratch_path(spark, "csv-orders"), "csv")
    return read_csv_typed(spark, path, {"o_orderdate": "date"}, infer=True)


@register("csv_load_valid_rows", """
SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n_loaded,
       CAST(COUNT(*) FILTER (WHERE o_totalprice >= 100000) AS BIGINT) AS n_valid,
       ROUND(SUM(CASE WHEN o_totalprice >= 100000 THEN o_totalprice END), 2) AS sum_valid
FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY o_orderstatus
""")
def csv_load_valid_rows(spark, sf):
    """Urgent orders are written with a field too many; the load drops them, replaces the
    table and publishes the view of valid rows."""
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    line = F.concat_ws(",", *cols)
    lines = read_table(spark, sf, "orders", cols).select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(line, F.lit(",late"))).otherwise(line)
        .alias(",".join(cols)))
    path, out = scratch_path(spark, "csv-ragged"), scratch_path(spark, "loaded")
    # one column whose name is the header and a separator that no value has: lines as they are
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    loaded = load_table(spark, path, out, "valid_orders", valid=F.col("o_totalprice") >= 100000)
    n = loaded.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_loaded"))
    v = spark.table("valid_orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_valid"), F.round(F.sum("o_totalprice"), 2).alias("sum_valid"))
    return n.join(v, "o_orderstatus", "left").select(
        "o_orderstatus", "n_loaded", F.coalesce("n_valid", F.lit(0)).cast("bigint").alias("n_valid"), "sum_valid")


_PROFILED = ["region", "nation", "customer", "supplier", "labels"]


@register("csv_profile", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", CAST(COUNT(*) AS BIGINT) AS \"rows\", "
    f"CAST((SELECT COUNT(*) FROM (DESCRIBE {t})) AS INTEGER) AS cols, "
    f"CAST((SELECT COUNT(*) FROM (DESCRIBE {t})) AS BIGINT) AS profiled, false AS failed FROM {t}"
    for t in _PROFILED))
def csv_profile(spark, sf):
    """The profiling job over a folder of CSV tables, found by listing it."""
    folder = scratch_path(spark, "csv-folder")
    for t in _PROFILED:
        write_table(read_table(spark, sf, t), f"{folder}/{t}.csv", "csv")
    prof = profile_raw(spark, folder)
    return prof.groupBy("table", "rows", "cols").agg(
        F.count("column").alias("profiled"), F.max(F.col("error").isNotNull()).alias("failed"))


@register("clean_rows", """
SELECT c_custkey, c_acctbal, CAST(0 AS DOUBLE) AS bonus
FROM customer WHERE c_acctbal > 0 AND c_acctbal BETWEEN 100 AND 9000
""")
def clean_rows(spark, sf):
    """The cleaners in a row: existing columns only, positive, inside a range, an absent
    fact as its default, columns dropped by name."""
    c = select_existing(read_table(spark, sf, "customer"), ["c_custkey", "c_acctbal", "c_name", "c_height"])
    c = keep_between(keep_positive(c, "c_acctbal"), "c_acctbal", 100, 9000)
    return drop_columns(default_numeric(c, ["bonus"]), ["c_name", "c_foot"])


@register("safe_dates", """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS day FROM orders
""")
def safe_dates(spark, sf):
    """Text dates, some of which name no day: a day or NULL, never a failed job."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("2001-13-45")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.withColumn("text", text).select("o_orderkey", safe_date("text").alias("day"))


@register("row_ids", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey) - 1 AS BIGINT) AS row_id FROM orders
""")
def row_ids(spark, sf):
    """Orders numbered by date and key."""
    return with_row_id(read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"]),
                       ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_id")


# ---------------------------------------------------------------------------
# A feature table that grows by batches; A5, A6: counts seen while loading
# ---------------------------------------------------------------------------

@register("incremental_features", ORACLE["lookback_totals"])
def incremental_features(spark, sf):
    """The lookback table built from three batches: orders and items up to a day, those after
    it, and items that come late. Each adds to the table by rewriting the cells it reaches."""
    store = FeatureStore(scratch_path(spark, "feature-store"), entity="o_custkey", anchor_time="o_orderdate", fact_time="l_shipdate",
                         measures={m: m for m in MEASURES}, windows=WINDOWS, entity_buckets=8, block_days=180)
    items = facts(spark, sf).select("o_custkey", "l_orderkey", "l_shipdate", *[c.alias(m) for m, c in measure_columns().items()])
    orders, day = anchors(spark, sf), F.lit(cutoff_for(spark, sf))
    late = F.col("l_orderkey") % 5 == 0
    store.add(spark, "1", orders.where(F.col("anchor_date") < day), items.where((F.to_date("l_shipdate") < day) & ~late))
    store.add(spark, "2", orders.where(F.col("anchor_date") >= day), items.where((F.to_date("l_shipdate") >= day) & ~late))
    store.add(spark, "3", facts=items.where(late))
    columns = [F.col(c) if c.endswith("games_played") else r6(F.col(c)).alias(c) for c in _LOOKBACK_COLS]
    return store.features(spark, ["o_orderkey", "o_custkey", "anchor_date", *columns])


@register("loaded_counts", """
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(CASE WHEN o_totalprice >= 100000 THEN 1 END) AS BIGINT) AS n_valid,
       CAST(COUNT(CASE WHEN o_totalprice >= 100000 THEN 1 END) AS BIGINT) AS n_view, CAST(0 AS BIGINT) AS n_old
FROM orders
""")
def loaded_counts(spark, sf):
    """Rows and valid rows as the manifest of a load knows them, the view's rows, and the rows
    of the table that was there before."""
    out = scratch_path(spark, "replaced")
    replace_table(read_table(spark, sf, "nation", ["n_name"]).select(F.col("n_name").alias("o_orderkey"), F.lit(-1.0).alias("o_totalprice")), out)
    path = write_table(read_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"]), scratch_path(spark, "csv-counts"), "csv")
    table = load_table(spark, path, out, "valid_orders", valid=F.col("o_totalprice") >= 100000)
    state = read_json(spark, f"{out}/{CURRENT}")
    price = F.col("o_totalprice")
    valid = spark.table("valid_orders").select(price, F.lit(1).alias("in_view"))
    return valid.unionByName(table.where(price < 0).select(price, F.lit(0).alias("in_view"))).agg(
        F.lit(state["rows"]).cast("bigint").alias("n_rows"), F.lit(state["valid"]).cast("bigint").alias("n_valid"),
        F.count(F.when(F.col("in_view") == 1, 1)).alias("n_view"), F.count(F.when(F.col("in_view") == 0, 1)).alias("n_old"))
