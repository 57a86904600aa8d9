"""Joins, aggregates, orderings and the gold marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.times import parse_ts, safe_cast
from ..operators.relational import (
    consecutive_pairs,
    count_by,
    distinct_count,
    enrich,
    explode_rows,
    first_last,
    left_match,
    rank_rows,
    sum_exploded,
    union_named,
)
from ..plans.marts import merge_trip_names, sales_by_city, silver_orders, silver_trips
from ..sources.files import stream_table, write_table
from ..streaming.aggregates import SumTarget
from ..streaming.run import run_batches, store_batches
from .base import AT, Tables, at, register


@register(
    "rel_projection",
    "REL-1",
    "SELECT o_orderkey, o_totalprice, o_orderstatus AS status, o_totalprice * 2 AS twice, upper(o_orderpriority) AS priority FROM orders",
)
def projection(t: Tables) -> DataFrame:
    return t("orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") * 2).alias("twice"),
        F.upper("o_orderpriority").alias("priority"),
    )


@register(
    "rel_filters",
    "REL-2",
    """
    SELECT c_custkey, c_name FROM customer WHERE c_name IS NOT NULL AND regexp_matches(c_name, '^Customer#0+[0-9]*[13579]$')
      AND (c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') OR c_mktsegment LIKE 'AUTO%') AND NOT length(c_name) < 5 AND c_nationkey <> 3""",
)
def filters(t: Tables) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    wanted = name.isNotNull() & name.rlike("^Customer#0+[0-9]*[13579]$")
    wanted &= segment.isin("HOUSEHOLD", "MACHINERY") | segment.like("AUTO%")
    return t("customer").where(wanted & ~(F.length(name) < 5) & (F.col("c_nationkey") != 3)).select("c_custkey", "c_name")


@register(
    "rel_enrich",
    "REL-3",
    """
    SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM (
      SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS c_custkey, o_custkey % 25 AS c_nationkey FROM orders) AS o
    LEFT JOIN customer AS c ON o.c_custkey = c.c_custkey AND o.c_nationkey = c.c_nationkey""",
)
def enriched(t: Tables) -> DataFrame:
    """A third of the keys is NULL and matches nothing."""
    orders = t("orders").select(
        "o_orderkey", F.when(F.expr("o_orderkey % 3 <> 0"), F.col("o_custkey")).alias("c_custkey"),
        F.expr("CAST(o_custkey % 25 AS INT)").alias("c_nationkey"),
    )
    joined = enrich(orders, t("customer"), ["c_custkey", "c_nationkey"])
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@register(
    "rel_consecutive_pairs",
    "REL-4 REL-11",
    """
    WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
    SELECT a.user_id, a.event_type AS before_event_type, a.ts AS before_ts, b.event_type AS after_event_type, b.ts AS after_ts
    FROM numbered AS a JOIN numbered AS b ON a.user_id = b.user_id AND b.rn = a.rn + 1""",
)
def pairs(t: Tables) -> DataFrame:
    return consecutive_pairs(t("events"), ["user_id"], ["ts", "event_id"], ["event_type", "ts"])


@register(
    "rel_first_last",
    "REL-5",
    """
    WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS up,
                             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS down FROM events)
    SELECT f.user_id, f.event_type AS first_event_type, f.ts AS first_ts, l.event_type AS last_event_type, l.ts AS last_ts
    FROM numbered AS f JOIN numbered AS l ON f.user_id = l.user_id WHERE f.up = 1 AND l.down = 1""",
)
def ends(t: Tables) -> DataFrame:
    return first_last(t("events"), ["user_id"], ["ts", "event_id"], ["event_type", "ts"])


@register(
    "rel_left_match",
    "REL-6",
    """
    SELECT c.c_custkey, o.o_custkey IS NOT NULL AS has_orders FROM customer AS c
    LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') AS o ON c.c_custkey = o.o_custkey""",
)
def matched(t: Tables) -> DataFrame:
    buyers = t("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return left_match(t("customer").select("c_custkey"), buyers, ["c_custkey"], "has_orders")


def _order_lines(t: Tables) -> DataFrame:
    """Each line item as an order message with an array of two products, made from its own columns."""
    product = lambda curr, price, qty: F.struct(F.lit(curr).alias("curr"), F.expr(price).alias("price"), F.expr(qty).alias("qty"))
    return t("lineitem").select(
        F.col("l_orderkey"),
        F.col("l_returnflag"),
        F.array(
            product("USD", "CAST(l_extendedprice AS DECIMAL(18,2))", "CAST(l_quantity AS BIGINT)"),
            product("EUR", "CAST(l_quantity AS DECIMAL(18,2))", "CAST(l_linenumber AS BIGINT)"),
        ).alias("ordered_products"),
    )


@register(
    "rel_sum_exploded",
    "REL-7 REL-12",
    """
    SELECT l_returnflag, 'USD' AS currency, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY l_returnflag
    UNION ALL SELECT l_returnflag, 'EUR', CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), CAST(sum(l_linenumber) AS BIGINT)
    FROM lineitem GROUP BY l_returnflag""",
)
def exploded_sums(t: Tables) -> DataFrame:
    sums = sum_exploded(
        _order_lines(t), "ordered_products", ["l_returnflag"], {"currency": "curr"}, {"sales": "price", "quantity": "qty"}
    )
    return sums.withColumn("sales", F.col("sales").cast("double"))


@register("rel_count_by", "REL-8", "SELECT event_type, user_id, count(*) AS rcrd_cnt FROM events GROUP BY ALL")
def counted(t: Tables) -> DataFrame:
    return count_by(t("events"), ["event_type", "user_id"])


@register("rel_distinct_count", "REL-9", "SELECT count(*) AS n_distinct FROM (SELECT DISTINCT user_id, event_type FROM events) AS e")
def distinct(t: Tables) -> DataFrame:
    return distinct_count(t("events"), ["user_id", "event_type"])


@register(
    "rel_union_named",
    "REL-10",
    """
    SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier UNION ALL SELECT p_partkey, p_name, NULL FROM part""",
    text=("nation",),
)
def united(t: Tables) -> DataFrame:
    return union_named(
        [
            t("customer").selectExpr("c_nationkey AS nation", "c_custkey AS key", "c_name AS name"),
            t("supplier").selectExpr("s_suppkey AS key", "s_name AS name", "s_nationkey AS nation"),
            t("part").selectExpr("p_name AS name", "p_partkey AS key"),
        ],
        allow_missing=True,
    )


RANKS_SQL = """
    SELECT event_id, CAST(row_number() OVER (PARTITION BY {0} ORDER BY ts, event_id) AS INTEGER) AS rn_asc,
           CAST(row_number() OVER (PARTITION BY {0} ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rn_desc FROM events"""


@register("rel_rank_rows", "REL-11", RANKS_SQL.format("user_id"))
def ranked(t: Tables) -> DataFrame:
    events = t("events").select("event_id", "user_id", "ts")
    return rank_rows(events, ["user_id"], ["ts", "event_id"]).select("event_id", "rn_asc", "rn_desc")


@register("rel_rank_hot_key", "REL-11", RANKS_SQL.format("event_type"))
def ranked_hot(t: Tables) -> DataFrame:
    """All keys are above the limit, so positions are counted slice by slice."""
    events = t("events").select("event_id", "event_type", "ts")
    return rank_rows(events, ["event_type"], ["ts", "event_id"], hot_rows=500).select("event_id", "rn_asc", "rn_desc")


@register(
    "rel_explode",
    "REL-12",
    """
    SELECT c_custkey, word FROM (SELECT c_custkey, unnest(string_split(c_mktsegment, 'E')) AS word FROM customer WHERE c_custkey % 4 <> 0) AS c
    UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey % 4 = 0""",
)
def exploded(t: Tables) -> DataFrame:
    words = F.when(F.expr("c_custkey % 4 <> 0"), F.split("c_mktsegment", "E"))
    return explode_rows(t("customer").select("c_custkey", words.alias("words")), "words", outer=True, alias="word")


@register("rel_sort", "REL-13", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC")
def ordered(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice").orderBy("o_orderstatus", F.col("o_totalprice").desc())


@register(
    "rel_sort_positions",
    "REL-13 REL-11",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_totalprice, o_orderkey) AS position FROM orders""",
)
def positions(t: Tables) -> DataFrame:
    """Where each row stands in the order of the whole table, counted over sorted slices and not in one task."""
    rows = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(1).alias("all"))
    ranked = rank_rows(rows, ["all"], ["o_orderstatus", "o_totalprice", "o_orderkey"], hot_rows=1000)
    return ranked.select("o_orderkey", F.col("rn_asc").alias("position"))


CTE = """
    WITH spent AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total FROM orders GROUP BY o_custkey),
    big AS (SELECT * FROM spent WHERE total > (SELECT avg(total) FROM spent))
    SELECT c.c_mktsegment, count(*) AS n, CAST(max(total) AS DOUBLE) AS top FROM customer AS c JOIN big AS b ON c.c_custkey = b.o_custkey
    GROUP BY c.c_mktsegment"""


@register("rel_cte", "REL-14", CTE)
def cte(t: Tables) -> DataFrame:
    return t.spark.sql(
        CTE.replace("FROM orders", "FROM {orders}").replace("FROM customer", "FROM {customer}"), orders=t("orders"), customer=t("customer")
    )


@register(
    "rel_expressions",
    "REL-15",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'partial' ELSE 'open' END AS state,
           o_orderstatus || '-' || o_orderpriority AS label, concat(o_orderstatus, '/', o_orderpriority) AS path, 'fixed' AS lit,
           CAST(3 AS INTEGER) AS n_items, o_orderpriority AS packed_priority FROM orders""",
)
def expressions(t: Tables) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    packed = F.named_struct(F.lit("status"), status, F.lit("priority"), priority)
    return t("orders").select(
        "o_orderkey",
        F.when(status == "F", "done").when(status == "P", "partial").otherwise("open").alias("state"),
        F.expr("o_orderstatus || '-' || o_orderpriority").alias("label"),
        F.concat(status, F.lit("/"), priority).alias("path"),
        F.lit("fixed").alias("lit"),
        F.size(F.array(status, priority, F.lit("x"))).alias("n_items"),
        packed["priority"].alias("packed_priority"),
    )


@register(
    "rel_parse_ts",
    "REL-16",
    """
    SELECT event_id, CASE WHEN event_id % 8 <> 0 THEN date_trunc('second', ts) END AS parsed,
           CASE WHEN event_id % 8 <> 0 THEN CAST(ts AS DATE) END AS day FROM events""",
    text=("day",),
)
def parsed_times(t: Tables) -> DataFrame:
    text = F.when(F.expr("event_id % 8 = 0"), F.lit("not a time")).otherwise(F.date_format("ts", "M/d/yyyy HH:mm:ss"))
    parsed = parse_ts(text, "M/d/yyyy HH:mm:ss")
    return t("events").select("event_id", parsed.cast("timestamp_ntz").alias("parsed"), parsed.cast("date").alias("day"))


@register(
    "rel_safe_cast",
    "REL-17",
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS INTEGER) END AS as_int,
           CASE event_id % 3 WHEN 1 THEN true END AS as_bool, CASE event_id % 3 WHEN 2 THEN TIMESTAMP '2024-05-06 07:08:09' END AS as_ts FROM events""",
    text=("as_int", "as_bool"),
)
def casts(t: Tables) -> DataFrame:
    text = F.expr("CASE event_id % 3 WHEN 0 THEN concat('', event_id) WHEN 1 THEN 'true' ELSE '2024-05-06 07:08:09' END")
    rows = t("events").select("event_id", text.alias("s"))
    return rows.select(
        "event_id", safe_cast(F.col("s"), "int").alias("as_int"), safe_cast(F.col("s"), "boolean").alias("as_bool"),
        safe_cast(F.col("s"), "timestamp_ntz").alias("as_ts"),
    ).withColumn("as_ts", F.when(F.expr("event_id % 3 = 2"), F.col("as_ts"))).withColumn(
        "as_bool", F.when(F.expr("event_id % 3 = 1"), F.col("as_bool"))
    )


# The silver columns the test tables can fill.
DELIVERED = [
    "customer_id", "customer_name", "number_of_line_items", "order_datetime", "order_date", "order_number", "ordered_products", "city",
    "loyalty_segment", "data_ingestion_ts",
]


def _bronze_orders(t: Tables) -> DataFrame:
    """Line items as raw order messages: order time as epoch text, products as an array."""
    orders = t("orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string").alias("order_datetime"),
    )
    number = F.when(F.expr("l_orderkey % 10 <> 0"), F.col("l_orderkey"))
    return _order_lines(t).join(orders, "l_orderkey").select(
        "customer_id", F.format_string("Customer#%09d", "customer_id").alias("customer_name"), "order_datetime",
        number.alias("order_number"), F.size("ordered_products").alias("number_of_line_items"), "ordered_products",
        at().alias("data_ingestion_ts"),
    )


def _customers(t: Tables) -> DataFrame:
    return t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("loyalty_segment"),
    )


BRONZE_SQL = """
    silver AS (
      SELECT o.o_custkey AS customer_id, c.c_name AS customer_name, o.o_orderdate AS order_datetime, CAST(o.o_orderdate AS DATE) AS order_date,
             l.l_orderkey AS order_number, n.n_name AS city, l.l_extendedprice, l.l_quantity, l.l_linenumber
      FROM lineitem AS l JOIN orders AS o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer AS c ON o.o_custkey = c.c_custkey
      LEFT JOIN nation AS n ON c.c_nationkey = n.n_nationkey WHERE l.l_orderkey % 10 <> 0)"""


@register(
    "rel_silver_orders",
    "REL-19 REL-3 JSN-15 DQ-2",
    f"WITH {BRONZE_SQL} SELECT customer_id, customer_name, order_datetime, order_date, order_number, city, CAST(2 AS INTEGER) AS number_of_line_items FROM silver",
)
def orders_silver(t: Tables) -> DataFrame:
    rows = silver_orders(_bronze_orders(t), _customers(t), columns=DELIVERED)
    return rows.select(
        "customer_id", "customer_name", F.col("order_datetime").cast("timestamp_ntz").alias("order_datetime"), "order_date",
        "order_number", "city", "number_of_line_items",
    )


CITY_SQL = f"""
    WITH {BRONZE_SQL}, products AS (
      SELECT *, 'USD' AS currency, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS BIGINT) AS qty FROM silver
      UNION ALL SELECT *, 'EUR', CAST(l_quantity AS DECIMAL(18,2)), CAST(l_linenumber AS BIGINT) FROM silver)
    SELECT order_date, city, customer_id, customer_name, currency, CAST(sum(price) AS DOUBLE) AS sales, CAST(sum(qty) AS BIGINT) AS quantity
    FROM products WHERE city = 'NATION_7' GROUP BY ALL"""


@register("rel_sales_by_city", "REL-18 REL-7 REL-19", CITY_SQL)
def city_mart(t: Tables) -> DataFrame:
    mart = sales_by_city(silver_orders(_bronze_orders(t), _customers(t), columns=DELIVERED), "NATION_7")
    return mart.withColumn("sales", F.col("sales").cast("double"))


@register("flow_retail_stream", "REL-3 REL-18 REL-19 SRC-14 SRC-16 SRC-19", CITY_SQL)
def retail_stream(t: Tables) -> DataFrame:
    """Bronze orders as a stream joined with customers into silver, and silver as a stream summed up into gold."""
    bronze, silver, gold = t.scratch("bronze"), t.scratch("silver"), t.scratch("gold")
    write_table(_bronze_orders(t), bronze)
    store_batches(stream_table(t.spark, bronze), lambda batch: silver_orders(batch, _customers(t), columns=DELIVERED), silver, t.scratch("checkpoint"))
    target = SumTarget(gold, ["order_date", "city", "customer_id", "customer_name", "currency"], ["sales", "quantity"])
    run_batches(
        stream_table(t.spark, silver), lambda batch, n: target.upsert(sales_by_city(batch, "NATION_7"), n), t.scratch("checkpoint")
    )
    return target.read(t.spark).withColumn("sales", F.col("sales").cast("double"))


@register(
    "rel_silver_trips",
    "REL-20 REL-16 STD-8",
    f"""
    SELECT CAST(event_id % 60 AS BIGINT) AS trip_duration, date_trunc('second', ts) AS start_time, user_id AS start_station_id,
           event_id AS bike_id, concat(upper(event_type[1]), event_type[2:]) AS user_type, CAST(1900 + event_id % 100 AS DOUBLE) AS birth_year,
           TIMESTAMP '{AT}' AS file_modification_time FROM events""",
)
def trips(t: Tables) -> DataFrame:
    """Half of the rows use the old attribute names, and names are not clean."""
    old = F.expr("event_id % 2 = 0")
    raw = t("events").select(
        F.when(old, F.expr("event_id % 60")).alias("TripDuration"), F.when(~old, F.expr("event_id % 60")).alias("Trip Duration"),
        F.date_format("ts", "M/d/yyyy HH:mm:ss").alias("starttime"), F.date_format("ts", "M/d/yyyy HH:mm:ss").alias("stoptime"),
        F.col("user_id").cast("string").alias("start_station_id"), F.col("event_id").alias("bikeid"), F.col("event_type").alias("usertype"),
        F.expr("1900 + event_id % 100").alias("birth_year"), F.lit("trips.parquet").alias("source_file"),
        at().alias("file_modification_time"),
    )
    rows = silver_trips(merge_trip_names(raw, missing="null"))
    return rows.select(
        "trip_duration", F.col("start_time").cast("timestamp_ntz").alias("start_time"), "start_station_id", "bike_id", "user_type",
        "birth_year", F.col("file_modification_time").cast("timestamp_ntz").alias("file_modification_time"),
    )
