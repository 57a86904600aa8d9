"""Tables kept up to date from changes, clustered layouts and shredded rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.changes import CHANGE_TYPE
from ..operators.digests import change_feed_by_digest, digest_tree
from ..operators.shred import ROOT, reassemble, shred
from ..plans.curve import write_clustered
from ..streaming.deltas import DeltaMart
from ..streaming.keyed import KeyedScd
from .base import ENTRIES, Tables, at, files_for, register
from .changes import end_as_text, snapshots, spans_sql


def _kept_by_key(t: Tables, target: KeyedScd) -> DataFrame:
    """Events arrive in four micro-batches in no order; a third of them arrives again, in other batches."""
    landing = t.scratch("landing")
    events = t("events").select("user_id", "event_id", "event_type", "ts", "value")
    files = files_for(events.count(), 4)
    events.unionByName(events.where("event_id % 3 = 0")).repartition(4 * files).write.parquet(landing)
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(landing)
    target.run(stream, t.scratch("checkpoint"))
    return target.read(t.spark)


@register("cdc_state_scd1", "CDC-3 SRC-14", ENTRIES["cdc_stream_scd1"].sql)
def state_scd1(t: Tables) -> DataFrame:
    return _kept_by_key(t, KeyedScd(t.scratch("latest"), ["user_id"], ["ts", "event_id"], 1, "event_type = 'error'"))


@register("cdc_state_scd2", "CDC-4 SRC-14", spans_sql("user_id", "event_type"))
def state_scd2(t: Tables) -> DataFrame:
    target = KeyedScd(
        t.scratch("versions"), ["user_id"], ["ts", "event_id"], 2, except_cols=["ts"], track=["event_type"], valid_from="ts"
    )
    return end_as_text(_kept_by_key(t, target))


@register("cdc_state_deletes", "CDC-4 CDC-5 SRC-14", ENTRIES["cdc_delete_when"].sql)
def state_deletes(t: Tables) -> DataFrame:
    target = KeyedScd(
        t.scratch("versions"), ["user_id"], ["ts", "event_id"], 2, "event_type = 'error'", except_cols=["ts", "value"], valid_from="ts"
    )
    return end_as_text(_kept_by_key(t, target))


# Every fifth order moves to another city, every eleventh goes, and one city loses all of its orders.
CITY_ORDERS = """
    SELECT o_orderkey, concat('NATION_', c_nationkey) AS old_city, concat('NATION_', CASE WHEN o_orderkey % 5 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END) AS city,
           CAST(o_totalprice AS DECIMAL(18,2)) AS dollars, o_orderkey % 10 AS qty FROM orders JOIN customer ON o_custkey = c_custkey"""
GONE = "(o_orderkey % 11 = 0 OR city = 'NATION_3')"


@register(
    "rel_mart_from_changes",
    "REL-18 REL-7 CDC-1 SRC-14",
    f"""
    WITH kept AS (SELECT * FROM ({CITY_ORDERS}) AS o WHERE NOT {GONE}),
    products AS (SELECT city, 'USD' AS currency, dollars AS price, qty FROM kept UNION ALL SELECT city, 'EUR', CAST(1 AS DECIMAL(18,2)), NULL FROM kept)
    SELECT city, currency, CAST(sum(price) AS DOUBLE) AS sales, CAST(sum(qty) AS BIGINT) AS quantity, count(*) AS n_rows FROM products GROUP BY city, currency""",
    text=("quantity",),
)
def mart_from_changes(t: Tables) -> DataFrame:
    """A feed of inserts, moves and deletes in four micro-batches; read after two more are folded in."""
    orders = t.spark.sql(CITY_ORDERS.replace("FROM orders", "FROM {orders}").replace("JOIN customer", "JOIN {customer}"), orders=t("orders"), customer=t("customer"))
    product = lambda curr, price, qty: F.struct(F.lit(curr).alias("curr"), price.alias("price"), qty.alias("qty"))
    one = F.lit(1).cast("decimal(18,2)")
    products = F.array(product("USD", F.col("dollars"), F.col("qty")), product("EUR", one, F.lit(None).cast("bigint")))
    rows = orders.withColumn("ordered_products", products)

    def images(city: str, kind: str, where: str) -> DataFrame:
        return rows.where(where).select(F.col(city).alias("city"), "ordered_products", F.lit(kind).alias(CHANGE_TYPE))

    moved = "o_orderkey % 5 = 0"
    first = images("old_city", "insert", "true").unionByName(images("old_city", "update_preimage", moved))
    later = images("city", "update_postimage", moved).unionByName(images("city", "delete", GONE))
    landing = t.scratch("feed")
    files = files_for(t("orders").count(), 4)
    first.unionByName(later.where("city <> 'NATION_3'")).repartition(4 * files).write.parquet(landing)
    mart = DeltaMart(
        t.scratch("mart"), ["city", "currency"], ["sales", "quantity"],
        lambda feed: feed.select("city", CHANGE_TYPE, F.inline("ordered_products").alias("currency", "sales", "quantity")),
    )
    stream = t.spark.readStream.schema(first.schema).option("maxFilesPerTrigger", files).parquet(landing)
    checkpoint = t.scratch("checkpoint")
    mart.run(stream, checkpoint)
    mart.fold(t.spark)
    later.where("city = 'NATION_3'").repartition(2 * files).write.mode("append").parquet(landing)
    mart.run(stream, checkpoint)
    return mart.read(t.spark).withColumn("sales", F.col("sales").cast("double"))


CLUSTERED = "l_partkey BETWEEN 100 AND 120", "l_shipdate < DATE '1992-06-01'"


@register(
    "source_curve_layout",
    "SRC-16 SRC-15",
    " UNION ALL ".join(f"SELECT {at} AS filter, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE {where}" for at, where in enumerate(CLUSTERED)),
)
def curve_layout(t: Tables) -> DataFrame:
    """Half of the lines is written along the curve and the other half appended; both columns are filtered on."""
    lines, path = t("lineitem"), t.scratch("curve")
    write_clustered(lines.where("l_orderkey % 2 = 0"), path, ["l_partkey", "l_shipdate"], 16)
    write_clustered(lines.where("l_orderkey % 2 = 1"), path, ["l_partkey", "l_shipdate"], 16, "append")
    stored = t.spark.read.parquet(path)
    found = [stored.where(where).select(F.lit(at).alias("filter"), "l_orderkey", "l_linenumber", "l_quantity") for at, where in enumerate(CLUSTERED)]
    return found[0].unionByName(found[1])


def _nested_orders(t: Tables) -> DataFrame:
    """Orders as JSON with two sibling arrays, one of which holds arrays itself; NULL, empty and filled ones."""
    part = lambda n: F.struct(F.expr(n).alias("n"))
    line = lambda kind, parts: F.struct(F.lit(kind).alias("kind"), parts.alias("parts"))
    no_parts = F.array().cast("array<struct<n:bigint>>")
    lines = F.array(line("low", F.array(part("o_orderkey % 7"), part("o_orderkey % 5"))), line("high", no_parts))
    notes = F.when(F.expr("o_orderkey % 4 = 0"), F.array().cast("array<struct<text:string>>")).when(
        F.expr("o_orderkey % 4 > 1"), F.array(F.struct(F.col("o_orderpriority").alias("text")), F.struct(F.col("o_orderstatus").alias("text")))
    )
    order = F.struct(F.col("o_orderkey").alias("key"), F.struct(lines.alias("lines"), F.col("o_custkey").alias("customer")).alias("body"), notes.alias("notes"))
    kind = "key BIGINT, body STRUCT<lines: ARRAY<STRUCT<kind: STRING, parts: ARRAY<STRUCT<n: BIGINT>>>>, customer: BIGINT>, notes ARRAY<STRUCT<text: STRING>>"
    return t("orders").select(F.from_json(F.to_json(order), kind).alias("o")).select("o.*")


@register(
    "json_shred",
    "JSN-14 JSN-10 REL-12",
    """
    SELECT 'rows' AS path, o_orderkey AS key, '' AS positions,
           concat(o_custkey, ' 2 ', CASE o_orderkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '-' ELSE '2' END) AS value FROM orders
    UNION ALL SELECT 'body.lines', o_orderkey, '0', 'low 2' FROM orders UNION ALL SELECT 'body.lines', o_orderkey, '1', 'high 0' FROM orders
    UNION ALL SELECT 'body.lines.parts', o_orderkey, '0 0', concat('', o_orderkey % 7) FROM orders
    UNION ALL SELECT 'body.lines.parts', o_orderkey, '0 1', concat('', o_orderkey % 5) FROM orders
    UNION ALL SELECT 'notes', o_orderkey, '0', o_orderpriority FROM orders WHERE o_orderkey % 4 > 1
    UNION ALL SELECT 'notes', o_orderkey, '1', o_orderstatus FROM orders WHERE o_orderkey % 4 > 1""",
)
def shredded(t: Tables) -> DataFrame:
    """One table per array path; sibling arrays do not multiply."""
    tables = shred(_nested_orders(t), ["key"])
    size = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("-"))
    values = {
        ROOT: F.concat_ws(" ", "body.customer", size("body.lines"), size("notes")),
        "body.lines": F.concat_ws(" ", "element.kind", size("element.parts")),
        "body.lines.parts": F.col("element.n").cast("string"),
        "notes": F.col("element.text"),
    }
    rows = []
    for path, value in values.items():
        positions = F.lit("") if path == ROOT else F.array_join(F.transform("positions", lambda x: x.cast("string")), " ")
        rows.append(tables[path].select(F.lit(path or "rows").alias("path"), "key", positions.alias("positions"), value.alias("value")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@register(
    "json_reassemble",
    "JSN-14",
    """
    SELECT o_orderkey AS key, concat('{"lines":[{"kind":"low","parts":[{"n":', o_orderkey % 7, '},{"n":', o_orderkey % 5, '}]},{"kind":"high","parts":[]}],"customer":',
             o_custkey, '}') AS body,
           CASE WHEN o_orderkey % 4 = 0 THEN '[]' WHEN o_orderkey % 4 > 1 THEN concat('[{"text":"', o_orderpriority, '"},{"text":"', o_orderstatus, '"}]') END AS notes
    FROM orders""",
)
def reassembled(t: Tables) -> DataFrame:
    """The shreds are stored and put together again."""
    nested = _nested_orders(t)
    stored = {}
    for path, table in shred(nested, ["key"]).items():
        where = t.scratch("shred")
        table.write.parquet(where)
        stored[path] = t.spark.read.parquet(where)
    whole = reassemble(stored, nested.schema, ["key"])
    return whole.select("key", F.to_json("body").alias("body"), F.to_json("notes").alias("notes"))


@register("cdc_digest_feed", "CDC-1", ENTRIES["cdc_change_feed"].sql)
def digest_feed(t: Tables) -> DataFrame:
    """The older snapshot's tree is stored with it."""
    before, after = snapshots(t)
    path = t.scratch("tree")
    digest_tree(before, ["o_orderkey"]).write.parquet(path)
    return change_feed_by_digest(before, after, ["o_orderkey"], 2, at(), (t.spark.read.parquet(path), None))
