"""Checked queries: each operator run over the given tables, with its oracle SQL.

Every query reads whole tables. Where an incremental load needs a "stored"
and an "incoming" side, both come from the same table split by date with an
overlap — the shape of daily files that re-deliver some earlier days — so
together they cover every row. The technical and business metadata are small
configuration tables and are given inline, as a user would write them.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.keys import with_partition_day
from .functions.names import clean_columns, clean_name_expr
from .operators.failures import failed_cast, failed_cells, failure_counts
from .operators.fold import FILE_COL, fold_new_rows
from .operators.increment import (
    anti_join_new,
    hot_keys,
    load_counts,
    new_lake_rows,
    partition_values,
    prune_to_batch,
)
from .operators.membership import day_bitmaps, domain_bits, new_rows_by_bitmap
from .operators.project import typed_projection
from .operators.routing import BUSINESS_COLUMNS, route
from .operators.spec import specs_from_rows
from .config import LakeConfig
from .plans.conformed import conformed_batch, load_conformed
from .plans.target import Target
from .plans.typed import load_enriched, typed_after_load, typed_batch
from .plans.warehouse import load_warehouse
from .session import ensure_checkpoint_dir
from .sources.keyindex import KeyIndex, new_by_index

# The load time used by every checked query.
LOAD_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)
LOAD_TS_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
# Rows per key above which new_events_hot_keys treats a key as hot.
HOT_EVENT_ROWS = 8

_TECH_KEYS = ("columnname", "colseq", "delta", "sql", "hashkeycheck", "partitionkeycheck", "clusterindexcol")


def _spec(dataset: str, rows: list[tuple]):
    return specs_from_rows(dataset, [dict(zip(_TECH_KEYS, r)) for r in rows])


# Technical metadata of the checked datasets. Flags are mixed case and colseq
# values sort differently as text and as numbers, on purpose.
ORDERS = _spec(
    "orders_feed",
    [
        ("o_orderkey", "1", "bigint", "bigint", "Y", "N", "Y"),
        ("o_custkey", "2", "bigint", "bigint", "Y", "N", "N"),
        ("o_orderstatus", "3", "string", "varchar(1)", "y", "N", "N"),
        ("o_totalprice", "10", "decimal(12,2)", "decimal(12,2)", "N", "N", "N"),
        ("o_orderdate", "11", "date", "date", "N", "Y", "N"),
    ],
)
LINEITEM = _spec(
    "lineitem_feed",
    [
        ("l_orderkey", "1", "bigint", "bigint", "Y", "N", "Y"),
        ("l_linenumber", "2", "int", "int", "Y", "N", "N"),
        ("l_quantity", "3", "decimal(12,2)", "decimal(12,2)", "N", "N", "N"),
        ("l_extendedprice", "4", "decimal(12,2)", "decimal(12,2)", "N", "N", "N"),
        ("l_shipdate", "11", "date", "date", "N", "y", "N"),
    ],
)
ORDERS_BY_CUSTOMER = _spec(
    "orders_feed",
    [
        ("o_custkey", "1", "bigint", "bigint", "Y", "N", "Y"),
        ("o_orderdate", "2", "date", "date", "N", "Y", "N"),
    ],
)
# First and last day of six overlapping deliveries, which hold every order.
SIX_FILES = [
    ("1900-01-01", "1996-03-31"),
    ("1995-10-01", "1997-06-30"),
    ("1995-06-01", "1996-12-31"),
    ("1997-01-01", "1999-03-31"),
    ("1998-06-01", "2000-06-30"),
    ("1999-10-01", "2100-12-31"),
]
ORDERS_FEED = _spec(
    "orders_feed",
    [
        ("o_custkey", "1", "bigint", "bigint", "Y", "N", "Y"),
        ("o_orderkey", "2", "bigint", "bigint", "N", "N", "N"),
        ("o_orderpriority", "3", "string", "varchar(5)", "N", "N", "N"),
        ("o_month", "4", "date", "date", "N", "Y", "N"),
    ],
)
THREE_FEEDS = [("1900-01-01", "1997-08-20"), ("1997-03-10", "1999-06-15"), ("1998-11-01", "2100-12-31")]
EVENTS = _spec(
    "events_feed",
    [
        ("user_id", "1", "bigint", "bigint", "Y", "N", "Y"),
        ("event_type", "2", "string", "varchar(10)", "Y", "N", "N"),
        ("ts", "3", "timestamp", "datetime", "N", "Y", "N"),
    ],
)
CUSTOMER_TEXT_AS_INT = _spec(
    "customer_feed",
    [
        ("c_custkey", "1", "bigint", "bigint", "Y", "N", "Y"),
        ("c_name", "2", "int", "int", "N", "N", "N"),
        ("c_acctbal", "3", "decimal(12,2)", "decimal(12,2)", "N", "N", "N"),
    ],
)
CUSTOMER_LOSSY = _spec(
    "customer_feed",
    [
        ("c_custkey", "1", "tinyint", "smallint", "Y", "N", "Y"),
        ("c_name", "2", "int", "date", "N", "N", "N"),
        ("c_acctbal", "3", "decimal(5,2)", "decimal(5,1)", "N", "N", "N"),
        ("c_mktsegment", "4", "boolean", "varchar(3)", "N", "Y", "N"),
    ],
)
CUSTOMER_WAREHOUSE = _spec(
    "customer_feed",
    [
        ("c_name", "1", "string", "varchar(12)", "Y", "N", "Y"),
        ("c_acctbal", "2", "double", "decimal(10,1)", "N", "N", "N"),
        ("c_mktsegment", "3", "string", "varchar(10)", "N", "Y", "N"),
    ],
)

# Business metadata for routing: datasets matched against page URLs used as
# file names. "utm_source" holds a LIKE wildcard ("_"), kept on purpose.
BUSINESS_ROWS = [
    ("spam-farm", "web", "crawl", "spam", "spam_pages", "dw", "web", "spam_pages", "v_spam_pages", "Y", "Y", "Y", "N", "Y"),
    ("cheap-pills", "web", "crawl", "spam", "pill_pages", "dw", "web", "pill_pages", "v_pill_pages", "Y", "Y", "N", "N", "N"),
    ("blog.", "web", "crawl", "blogs", "blog_pages", "dw", "web", "blog_pages", "v_blog_pages", "N", "Y", "Y", "Y", "Y"),
    ("/fr/", "web", "crawl", "lang", "french_pages", "dw", "web", "french_pages", "v_french_pages", "Y", "Y", "Y", "N", "N"),
    (" Example.ORG ", "web", "crawl", "tld", "org_pages", "dw", "web", "org_pages", "v_org_pages", "Y", "N", "N", "N", "N"),
    ("utm_source", "web", "crawl", "tracking", "feed_pages", "dw", "web", "feed_pages", "v_feed_pages", "Y", "Y", "Y", "Y", "Y"),
    ("no-such-site", "web", "crawl", "none", "none_pages", "dw", "web", "none_pages", "v_none_pages", "Y", "Y", "Y", "Y", "Y"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- conformed


def conformed_orders(spark, sf_dir):
    """C2 + I1 + C3 + C4 + C5 over the whole orders table."""
    return conformed_batch(_table(spark, sf_dir, "orders"), ORDERS, LOAD_TS)


def conformed_lineitem(spark, sf_dir):
    return conformed_batch(_table(spark, sf_dir, "lineitem"), LINEITEM, LOAD_TS)


def conformed_events(spark, sf_dir):
    return conformed_batch(_table(spark, sf_dir, "events"), EVENTS, LOAD_TS)


def partition_days_events(spark, sf_dir):
    """the distinct partition days of a batch."""
    ev = clean_columns(_table(spark, sf_dir, "events"))
    return with_partition_day(ev.select("ts"), "ts").distinct()


def distinct_conversation_turns(spark, sf_dir):
    """Whole rows of an incoming file."""
    return clean_columns(_table(spark, sf_dir, "conversations")).distinct()


# -------------------------------------------------------- incremental loads


def _orders_split(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    stored = conformed_batch(orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")), ORDERS, LOAD_TS)
    batch = conformed_batch(orders.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp")), ORDERS, LOAD_TS)
    return stored, batch


def new_orders(spark, sf_dir):
    """D3 + E1 + I2: stored orders before 1998, a batch from 1997 on."""
    stored, batch = _orders_split(spark, sf_dir)
    return new_lake_rows(batch, stored, "o_orderdate")


def new_lineitem(spark, sf_dir):
    """E1 on the largest table: stored lines shipped before 1999, a batch
    from 1998 on (key: order and line number)."""
    li = _table(spark, sf_dir, "lineitem")
    stored = conformed_batch(li.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp")), LINEITEM, LOAD_TS)
    batch = conformed_batch(li.filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")), LINEITEM, LOAD_TS)
    return new_lake_rows(batch, stored, "l_shipdate")


def new_lineitem_bitmap(spark, sf_dir):
    """E1 / D3 through membership bitmaps by day: rows whose bit is clear skip
    the anti-join, with the rows of the plain one."""
    li = _table(spark, sf_dir, "lineitem")
    stored = conformed_batch(li.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp")), LINEITEM, LOAD_TS)
    batch = conformed_batch(li.filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")), LINEITEM, LOAD_TS)
    days = partition_values(batch, "l_shipdate")
    pruned = prune_to_batch(stored, batch, "l_shipdate", days)
    bits = domain_bits(pruned.count())
    return new_rows_by_bitmap(batch, pruned, day_bitmaps(pruned, "l_shipdate", bits), bits)


def pruned_stored_orders(spark, sf_dir):
    """D3 alone: stored rows in the batch's partition days."""
    stored, batch = _orders_split(spark, sf_dir)
    return prune_to_batch(stored, batch, "o_orderdate")


def new_events(spark, sf_dir):
    """E1 where pruning changes the answer: the key (user, type) repeats
    across days, and a key stored only on days outside the batch does not
    block a row."""
    ev = _table(spark, sf_dir, "events")
    stored = conformed_batch(ev.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp")), EVENTS, LOAD_TS)
    batch = conformed_batch(ev.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp")), EVENTS, LOAD_TS)
    return new_lake_rows(batch, stored, "ts")


def new_events_hot_keys(spark, sf_dir):
    """E1 as new_events, with frequent keys settled outside the shuffle: the
    threshold is low enough that many (user, type) keys count as hot here."""
    ev = _table(spark, sf_dir, "events")
    stored = conformed_batch(ev.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp")), EVENTS, LOAD_TS)
    batch = conformed_batch(ev.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp")), EVENTS, LOAD_TS)
    hot = hot_keys(batch, min_rows=HOT_EVENT_ROWS)
    return new_lake_rows(batch, stored, "ts", hot=hot)


def _by_customer(spark, sf_dir):
    """Orders keyed by customer, whose key comes back on many days."""
    return conformed_batch(_table(spark, sf_dir, "orders"), ORDERS_BY_CUSTOMER, LOAD_TS)


def orders_six_files(spark, sf_dir):
    """K5 / K9: six overlapping files of orders loaded at once, with the rows
    of loading them one after another (each row with its file)."""
    rows = _by_customer(spark, sf_dir)
    files = [
        rows.filter(F.col("o_orderdate").between(first, last)).withColumn(FILE_COL, F.lit(i))
        for i, (first, last) in enumerate(SIX_FILES)
    ]
    batch = reduce(DataFrame.unionByName, files)
    return fold_new_rows(batch, None, "o_orderdate").withColumnRenamed(FILE_COL, "file")


def load_counts_orders(spark, sf_dir):
    """existing, incoming, new and after-load row counts."""
    stored, batch = _orders_split(spark, sf_dir)
    return load_counts(stored, batch, new_lake_rows(batch, stored, "o_orderdate"))


def typed_new_orders(spark, sf_dir):
    """E1 on typed frames: the partition column is a date, the prune list
    text (C7 lake types on both sides)."""
    stored, batch = _orders_split(spark, sf_dir)
    return new_lake_rows(typed_batch(batch, ORDERS), typed_batch(stored, ORDERS), "o_orderdate")


def new_orders_warehouse(spark, sf_dir):
    """Warehouse anti-join on the hash, no pruning, no distinct."""
    conformed = conformed_batch(_table(spark, sf_dir, "orders"), ORDERS, LOAD_TS)
    enriched = typed_projection(conformed, ORDERS, "lake")
    typed = typed_projection(enriched, ORDERS, "sql")
    stored = typed.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("date"))
    return anti_join_new(typed, stored)


def new_orders_key_index(spark, sf_dir):
    """E2 / K8 through a key index: the stored hashes lie in a bucketed table,
    built by a first load and extended by a second; a third load's batch is
    the only side that moves."""
    conformed = conformed_batch(_table(spark, sf_dir, "orders"), ORDERS, LOAD_TS)
    typed = typed_projection(typed_projection(conformed, ORDERS, "lake"), ORDERS, "sql")
    run = uuid.uuid4().hex
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/keys-{run}"
    index = KeyIndex(spark, "strata_rows", f"orders_keys_{run}", folder, buckets=16)
    day = F.col("o_orderdate")
    index.build(typed.filter(day < F.lit("1998-01-01").cast("date")), "first")
    second = typed.filter(day.between(F.lit("1998-01-01").cast("date"), F.lit("1999-12-31").cast("date")))
    index.append(second, "second")
    return new_by_index(typed, index.keys("second"))


def late_enabled_layer(spark, sf_dir):
    """K6 on a target that does not exist yet: after two conformed loads, an
    enriched layer switched on late holds the rows of both."""
    stored, batch = _orders_split(spark, sf_dir)
    conformed = stored.unionByName(new_lake_rows(batch, stored, "o_orderdate"))
    return typed_after_load(None, conformed, ORDERS)


def enriched_after_two_loads(spark, sf_dir):
    """A6 + K6: the enriched layer after a load of each conformed state."""
    stored, batch = _orders_split(spark, sf_dir)
    first = typed_after_load(None, stored, ORDERS)
    return typed_after_load(first, stored.unionByName(new_lake_rows(batch, stored, "o_orderdate")), ORDERS)


def _feed_loads(spark, sf_dir, layers: list[tuple[bool, bool]]):
    """Orders as CSV feeds in the shared folder, loaded for real one after
    another: the conformed layer always, and for each feed whether the
    enriched layer and the warehouse are loaded as well."""
    run = uuid.uuid4().hex
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{run}"
    cfg = LakeConfig.under(folder, conformed_db=f"rows_c_{run}", enriched_db=f"rows_e_{run}", sandbox_db=f"rows_s_{run}")
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("o_month"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    for i, (first, last) in enumerate(THREE_FEEDS):
        path = f"{cfg.incoming}/orders_feed__{i}.csv"
        feed = orders.filter(F.col("day").between(first, last)).drop("day")
        feed.write.option("header", True).csv(path)
        t = Target(path, f"orders_feed__{i}.csv", "orders_feed", "rows", "tpch", "core", "orders", "dw", f"rows{run}", "orders", None)
        days = load_conformed(spark, cfg, t, ORDERS_FEED, LOAD_TS).partitions
        enriched, warehouse = layers[i]
        if enriched:
            days = load_enriched(spark, cfg, t, ORDERS_FEED, days).partitions
        if warehouse:
            load_warehouse(spark, cfg, t, ORDERS_FEED, days)
    return cfg, t


def conformed_after_loads(spark, sf_dir):
    """K5 as loads: the conformed layer after three overlapping CSV feeds."""
    cfg, t = _feed_loads(spark, sf_dir, [(False, False)] * 3)
    return spark.table(f"{cfg.conformed_db}.{t.catalog_table}")


def enriched_after_loads(spark, sf_dir):
    """K6 as loads: the enriched layer, loaded after every feed."""
    cfg, t = _feed_loads(spark, sf_dir, [(True, False)] * 3)
    return spark.table(f"{cfg.enriched_db}.{t.catalog_table}")


def warehouse_after_missed_load(spark, sf_dir):
    """K8 as loads: a warehouse whose layers were off for the second feed."""
    cfg, t = _feed_loads(spark, sf_dir, [(True, True), (False, False), (True, True)])
    return spark.table(f"{t.warehouse_db}.{t.sql_table}")


def renamed_columns_batch(spark, sf_dir):
    """A batch with raw headers, cleaned on the way in."""
    cust = _table(spark, sf_dir, "customer")
    raw = cust.select(*[F.col(c).alias(f"{c.upper()} [usd]") for c in cust.columns])
    return clean_columns(raw)


# ------------------------------------------------------------- projections


def typed_lineitem(spark, sf_dir):
    """C7 + C9: declared lake types, undeclared columns passed through."""
    return typed_projection(_table(spark, sf_dir, "lineitem"), LINEITEM, "lake")


def typed_customer_failing_casts(spark, sf_dir):
    """C7 with a cast that fails on every row (text to int) -> NULL."""
    return typed_projection(_table(spark, sf_dir, "customer"), CUSTOMER_TEXT_AS_INT, "lake")


def customer_cast_failures(spark, sf_dir):
    """Values that the declared lake types lose, counted by column."""
    cust = _table(spark, sf_dir, "customer")
    return failure_counts(cust, failed_cast(cust, CUSTOMER_LOSSY))


def customer_lost_values(spark, sf_dir):
    """Each lost value with its key, for the quarantine table."""
    cust = _table(spark, sf_dir, "customer")
    return failed_cells(cust, failed_cast(cust, CUSTOMER_LOSSY, "sql"), "c_custkey")


def warehouse_customer(spark, sf_dir):
    """C8 + A14 + I2: warehouse types with varchar truncation, then DISTINCT."""
    return typed_projection(_table(spark, sf_dir, "customer"), CUSTOMER_WAREHOUSE, "sql").distinct()


def clean_page_urls(spark, sf_dir):
    """C1 as a Column expression over whole URL texts."""
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", clean_name_expr("url").alias("url_clean"))


# ---------------------------------------------------------------- routing


def business_metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BUSINESS_ROWS, ", ".join(f"{c} string" for c in BUSINESS_COLUMNS))


def routed_pages(spark, sf_dir):
    """E3 + C11 + C13 + I3: page URLs as file names routed to datasets."""
    pages = _table(spark, sf_dir, "pages")
    files = pages.select(
        F.col("url").alias("path"),
        F.col("url").alias("name"),
        F.replace(F.col("url"), F.lit("__"), F.lit("_")).alias("d_name"),
    )
    return route(files, business_metadata(spark))


def routed_hosts(spark, sf_dir):
    """E3 with many names: every page URL against the host of every page, with
    some of its letters as wildcards, through the trigram index."""
    pages = _table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    names = pages.select(F.replace(host, F.lit("ther"), F.lit("th_r")).alias("dataset")).distinct()
    fixed = BUSINESS_ROWS[0]
    meta = names.select("dataset", *[F.lit(v).alias(c) for c, v in zip(BUSINESS_COLUMNS[1:], fixed[1:])])
    files = pages.select(
        F.col("url").alias("path"),
        F.col("url").alias("name"),
        F.replace(F.col("url"), F.lit("__"), F.lit("_")).alias("d_name"),
    )
    return route(files, meta).select("path", "dataset", "layer_subpath", "warehouse_table", "staging_schema")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conformed_orders": conformed_orders,
    "conformed_lineitem": conformed_lineitem,
    "conformed_events": conformed_events,
    "partition_days_events": partition_days_events,
    "distinct_conversation_turns": distinct_conversation_turns,
    "new_orders": new_orders,
    "pruned_stored_orders": pruned_stored_orders,
    "new_lineitem": new_lineitem,
    "new_lineitem_bitmap": new_lineitem_bitmap,
    "new_events": new_events,
    "new_events_hot_keys": new_events_hot_keys,
    "orders_six_files": orders_six_files,
    "load_counts_orders": load_counts_orders,
    "typed_new_orders": typed_new_orders,
    "new_orders_warehouse": new_orders_warehouse,
    "new_orders_key_index": new_orders_key_index,
    "late_enabled_layer": late_enabled_layer,
    "enriched_after_two_loads": enriched_after_two_loads,
    "conformed_after_loads": conformed_after_loads,
    "enriched_after_loads": enriched_after_loads,
    "warehouse_after_missed_load": warehouse_after_missed_load,
    "renamed_columns_batch": renamed_columns_batch,
    "typed_lineitem": typed_lineitem,
    "typed_customer_failing_casts": typed_customer_failing_casts,
    "customer_cast_failures": customer_cast_failures,
    "customer_lost_values": customer_lost_values,
    "warehouse_customer": warehouse_customer,
    "clean_page_urls": clean_page_urls,
    "routed_pages": routed_pages,
    "routed_hosts": routed_hosts,
}


# ------------------------------------------------------------- oracle SQL

_H = "upper(sha256(concat_ws('||', {})))"


def _hash(*cols: str) -> str:
    return _H.format(", ".join(f"CAST({c} AS VARCHAR)" for c in cols))


_CONF_ORDERS = f"""
SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
       {_hash('o_orderkey', 'o_custkey', 'o_orderstatus')} AS calhashkey,
       {LOAD_TS_SQL} AS calinsertdate, CAST(NULL AS TIMESTAMP) AS calupdatedate
FROM orders"""

_CONF_LINEITEM = f"""
SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
       {_hash('l_orderkey', 'l_linenumber')} AS calhashkey,
       {LOAD_TS_SQL} AS calinsertdate, CAST(NULL AS TIMESTAMP) AS calupdatedate
FROM lineitem"""

_CONF_EVENTS = f"""
SELECT DISTINCT event_id, strftime(ts, '%Y-%m-%d') AS ts, user_id, event_type, value, props,
       {_hash('user_id', 'event_type')} AS calhashkey,
       {LOAD_TS_SQL} AS calinsertdate, CAST(NULL AS TIMESTAMP) AS calupdatedate
FROM events"""

# Pruned anti-join in plain SQL: stored keys only from partitions present in
# the batch (NULL partition matched explicitly).
_NEW_ROWS = """
SELECT * FROM batch b
WHERE b.calhashkey NOT IN (
  SELECT s.calhashkey FROM stored s
  WHERE s.{p} IN (SELECT {p} FROM batch WHERE {p} IS NOT NULL)
     OR (s.{p} IS NULL AND EXISTS (SELECT 1 FROM batch WHERE {p} IS NULL)))"""

_ORDERS_SPLIT = f"""
WITH conf AS ({_CONF_ORDERS}),
stored AS (SELECT * FROM conf WHERE o_orderdate < '1998-01-01'),
batch AS (SELECT * FROM conf WHERE o_orderdate >= '1997-01-01')"""

_TYPED_ORDERS = """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
       CAST(o_orderstatus AS VARCHAR) AS o_orderstatus,
       TRY_CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       TRY_CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority, calhashkey, calinsertdate, calupdatedate
FROM {src}"""

_CLEAN_URL = "url"
for _step in (
    "lower({x})",
    "replace({x}, '%', 'percent')",
    "regexp_replace({x}, '\\[[^\\]]+\\]', '[]', 'g')",
    "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')",
    "replace({x}, ']', '')",
    "replace({x}, '[', '')",
    "replace({x}, '(', '')",
    "replace({x}, ';', '')",
    "replace({x}, ')', '')",
    "replace({x}, ' ', '_')",
    "replace({x}, ',', '')",
    "replace({x}, '/', '_')",
    "replace({x}, ':', '_')",
):
    _CLEAN_URL = _step.format(x=_CLEAN_URL)


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


_BUSINESS_VALUES = ",\n  ".join(
    "(" + ", ".join(_sql_str(v) for v in row) + ")" for row in BUSINESS_ROWS
)

ORACLE_SQL: dict[str, str] = {
    "conformed_orders": _CONF_ORDERS,
    "conformed_lineitem": _CONF_LINEITEM,
    "conformed_events": _CONF_EVENTS,
    "partition_days_events": "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS ts FROM events",
    "distinct_conversation_turns": "SELECT DISTINCT * FROM conversations",
    "new_orders": _ORDERS_SPLIT + _NEW_ROWS.format(p="o_orderdate"),
    "pruned_stored_orders": _ORDERS_SPLIT
    + """
SELECT * FROM stored s
WHERE s.o_orderdate IN (SELECT o_orderdate FROM batch WHERE o_orderdate IS NOT NULL)
   OR (s.o_orderdate IS NULL AND EXISTS (SELECT 1 FROM batch WHERE o_orderdate IS NULL))""",
    "new_events": f"""
WITH conf AS ({_CONF_EVENTS}),
stored AS (SELECT * FROM conf WHERE ts < '2024-01-16'),
batch AS (SELECT * FROM conf WHERE ts >= '2024-01-10')"""
    + _NEW_ROWS.format(p="ts"),
    "load_counts_orders": _ORDERS_SPLIT
    + f""",
newrows AS ({_NEW_ROWS.format(p="o_orderdate")})
SELECT 'existing' AS metric, count(*) AS value FROM stored
UNION ALL SELECT 'incoming', count(*) FROM batch
UNION ALL SELECT 'new', count(*) FROM newrows
UNION ALL SELECT 'after', (SELECT count(*) FROM stored) + (SELECT count(*) FROM newrows)""",
    "typed_new_orders": f"""
WITH conf AS ({_CONF_ORDERS}),
stored AS (SELECT DISTINCT * FROM ({_TYPED_ORDERS.format(src="conf")}) WHERE o_orderdate < DATE '1998-01-01'),
batch AS (SELECT DISTINCT * FROM ({_TYPED_ORDERS.format(src="conf")}) WHERE o_orderdate >= DATE '1997-01-01')"""
    + _NEW_ROWS.format(p="o_orderdate"),
    "new_orders_warehouse": f"""
WITH conf AS ({_CONF_ORDERS}),
typed AS (
  SELECT o_orderkey, o_custkey, left(o_orderstatus, 1) AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority, calhashkey, calinsertdate, calupdatedate
  FROM ({_TYPED_ORDERS.format(src="conf")}))
SELECT * FROM typed
WHERE calhashkey NOT IN (SELECT calhashkey FROM typed WHERE o_orderdate < DATE '2000-01-01')""",
    "typed_lineitem": """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, TRY_CAST(l_linenumber AS INTEGER) AS l_linenumber,
       TRY_CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
       TRY_CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
       TRY_CAST(l_shipdate AS DATE) AS l_shipdate,
       l_partkey, l_suppkey, l_discount, l_tax, l_returnflag, l_linestatus
FROM lineitem""",
    "typed_customer_failing_casts": """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, TRY_CAST(c_name AS INTEGER) AS c_name,
       TRY_CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_nationkey, c_mktsegment
FROM customer""",
    "warehouse_customer": """
SELECT DISTINCT left(c_name, 12) AS c_name, TRY_CAST(c_acctbal AS DECIMAL(10,1)) AS c_acctbal,
       left(c_mktsegment, 10) AS c_mktsegment, c_custkey, c_nationkey
FROM customer""",
    "clean_page_urls": f"SELECT page_id, {_CLEAN_URL} AS url_clean FROM pages",
    "routed_pages": f"""
WITH meta({', '.join(BUSINESS_COLUMNS)}) AS (VALUES
  {_BUSINESS_VALUES})
SELECT DISTINCT p.url AS path, p.url AS name, {', '.join('m.' + c for c in BUSINESS_COLUMNS)},
       concat_ws('/', m.deltaLake_root, m.delta_database_name, m.delta_schema_name, m.deltaLake_table_name) AS layer_subpath,
       m.sql_schema_name || '_' || m.sql_table_name AS catalog_table,
       m.sql_database_name || '__' || m.sql_schema_name || '.' || m.sql_table_name AS warehouse_table,
       'staging_' || m.sql_database_name || '__' || m.sql_schema_name AS staging_schema
FROM pages p JOIN meta m
  ON lower(replace(p.url, '__', '_')) LIKE '%' || lower(trim(m.dataset)) || '%'""",
}


def _chain_sql(conf: str, day: str, part: str, ranges: list[tuple[str, str]]) -> str:
    """A chain of loads, each against what is there by then: s1, s2, ..."""
    steps = [f"WITH conf AS ({conf})", "s0 AS (SELECT *, -1 AS file FROM conf WHERE false)"]
    for i, (first, last) in enumerate(ranges):
        steps.append(f"f{i} AS (SELECT *, {i} AS file FROM conf WHERE {day} BETWEEN '{first}' AND '{last}')")
        steps.append(
            f"""s{i + 1} AS (SELECT * FROM s{i} UNION ALL SELECT * FROM f{i} WHERE calhashkey NOT IN (
  SELECT s.calhashkey FROM s{i} s WHERE s.{part} IN (SELECT {part} FROM f{i})))"""
        )
    return ",\n".join(steps)


_CONF_BY_CUSTOMER = _CONF_ORDERS.replace(_hash("o_orderkey", "o_custkey", "o_orderstatus"), _hash("o_custkey"))
ORACLE_SQL["orders_six_files"] = _chain_sql(_CONF_BY_CUSTOMER, "o_orderdate", "o_orderdate", SIX_FILES) + f"\nSELECT * FROM s{len(SIX_FILES)}"

_FEED = f"""
SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS o_month, strftime(o_orderdate, '%Y-%m-%d') AS day,
       {_hash('o_custkey')} AS calhashkey
FROM orders"""
_FEED_CHAIN = _chain_sql(_FEED, "day", "o_month", THREE_FEEDS)
_AUDIT = f"{LOAD_TS_SQL} AS calinsertdate, CAST(NULL AS TIMESTAMP) AS calupdatedate"
ORACLE_SQL["conformed_after_loads"] = _FEED_CHAIN + f"\nSELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_month, calhashkey, {_AUDIT} FROM s3"
# A key enters a typed layer with the first load that brings it.
ORACLE_SQL["enriched_after_loads"] = (
    _FEED_CHAIN
    + f"""
SELECT DISTINCT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority,
       CAST(o_month AS DATE) AS o_month, o_orderstatus, calhashkey, {_AUDIT}
FROM s3 WHERE file = (SELECT min(t.file) FROM s3 t WHERE t.calhashkey = s3.calhashkey)"""
)
ORACLE_SQL["warehouse_after_missed_load"] = (
    _FEED_CHAIN
    + """
SELECT DISTINCT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderkey AS BIGINT) AS o_orderkey, left(o_orderpriority, 5) AS o_orderpriority,
       CAST(o_month AS DATE) AS o_month, o_orderstatus, calhashkey, DATE '2024-02-01' AS calinsertdate, CAST(NULL AS DATE) AS calupdatedate
FROM s3 WHERE file = 0 OR calhashkey NOT IN (SELECT calhashkey FROM s1)"""
)

ORACLE_SQL["new_events_hot_keys"] = ORACLE_SQL["new_events"]

ORACLE_SQL["new_lineitem"] = (
    f"""
WITH conf AS ({_CONF_LINEITEM}),
stored AS (SELECT * FROM conf WHERE l_shipdate < '1999-01-01'),
batch AS (SELECT * FROM conf WHERE l_shipdate >= '1998-01-01')"""
    + _NEW_ROWS.format(p="l_shipdate")
)

ORACLE_SQL["new_orders_key_index"] = ORACLE_SQL["new_orders_warehouse"]

_LAKE_LOSSY = {"c_custkey": ("TINYINT", "tinyint"), "c_name": ("INTEGER", "int"), "c_acctbal": ("DECIMAL(5,2)", "decimal(5,2)"), "c_mktsegment": ("BOOLEAN", "boolean")}
_SQL_LOSSY = {"c_custkey": ("SMALLINT", "smallint"), "c_name": ("DATE", "date"), "c_acctbal": ("DECIMAL(5,1)", "decimal(5,1)")}
ORACLE_SQL["customer_cast_failures"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{text}' AS wanted, count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS failures FROM customer"
    for c, (t, text) in _LAKE_LOSSY.items()
)
ORACLE_SQL["customer_lost_values"] = "\nUNION ALL\n".join(
    f"SELECT c_custkey, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, '{text}' AS wanted FROM customer WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL"
    for c, (t, text) in _SQL_LOSSY.items()
)

ORACLE_SQL["routed_hosts"] = """
WITH names AS (SELECT DISTINCT replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'ther', 'th_r') AS dataset FROM pages)
SELECT DISTINCT p.url AS path, n.dataset, 'web/crawl/spam/spam_pages' AS layer_subpath,
       'dw__web.spam_pages' AS warehouse_table, 'staging_dw__web' AS staging_schema
FROM pages p JOIN names n ON lower(replace(p.url, '__', '_')) LIKE '%' || lower(trim(n.dataset)) || '%'"""
ORACLE_SQL["new_lineitem_bitmap"] = ORACLE_SQL["new_lineitem"]

# Stored orders and the new ones are all orders once, typed.
ORACLE_SQL["late_enabled_layer"] = ORACLE_SQL["enriched_after_two_loads"] = (
    _ORDERS_SPLIT
    + f""",
newrows AS ({_NEW_ROWS.format(p="o_orderdate")}),
conformed AS (SELECT * FROM stored UNION ALL SELECT * FROM newrows)
SELECT DISTINCT * FROM ({_TYPED_ORDERS.format(src="conformed")})"""
)

ORACLE_SQL["renamed_columns_batch"] = """
SELECT c_custkey AS c_custkey_, c_name AS c_name_, c_nationkey AS c_nationkey_,
       c_acctbal AS c_acctbal_, c_mktsegment AS c_mktsegment_
FROM customer"""
