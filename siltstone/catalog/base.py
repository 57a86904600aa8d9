"""Registration of catalog queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import configure, scratch_path

AT = "2025-01-02 03:04:05"
# Rows of one file that a table lands in for a stream to pick up.
FILE_ROWS = 100_000


@dataclass(frozen=True)
class Entry:
    name: str
    operators: tuple[str, ...]
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


class Tables:
    """The test tables of one folder, and frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def export(self, df: DataFrame, fmt: str, **options: str) -> str:
        """Write a frame to a fresh shared folder, as raw files for a source to pick up."""
        path = self.scratch(f"export-{fmt}")
        df.write.format(fmt).options(**options).save(path)
        return path

    def patients(self) -> DataFrame:
        return self("customer").selectExpr(*PATIENTS)

    def patient_feed(self) -> DataFrame:
        raw = self("orders").withColumn("raw", F.expr(RAW_PAYLOAD))
        return raw.selectExpr(*PATIENT_FEED)


def register(name: str, operators: str, sql: str | None = None, text: tuple[str, ...] = ()):
    """Add a query to the catalog under `name`; `operators` lists the inventory IDs it covers.

    Columns in `text` are shown as text on both sides: numbers and flags with NULLs, and dates,
    have no common form in the frames the two engines hand out.
    """

    def wrap(function: Callable[[Tables], DataFrame]):
        def build(spark: SparkSession, folder: str) -> DataFrame:
            df = function(Tables(spark, folder))
            return df.withColumns({c: F.col(c).cast("string") for c in text}) if text else df

        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        shown = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in text)
        stated = f"SELECT * REPLACE ({shown}) FROM ({sql}) AS shown" if text else sql
        ENTRIES[name] = Entry(name, tuple(operators.split()), build, stated)
        return function

    return wrap


def files_for(rows: int, batches: int = 1) -> int:
    """How many files each of `batches` micro-batches takes, so that a batch grows by files and no file grows with the table."""
    return max(1, -(-rows // (batches * FILE_ROWS)))


def at():
    return F.lit(AT).cast("timestamp_ntz")


# Inputs below are written in SQL both engines read, so query and SQL start from the same rows.

PATIENTS = [
    "c_custkey",
    "CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE concat('P', c_custkey) END AS ID",
    "CASE WHEN c_custkey % 15 = 1 THEN NULL ELSE concat('B', c_custkey % 50) END AS BusinessID",
    "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '12345' ELSE concat('', 5550000000 + c_custkey) END AS PhoneNumber",
    "CASE WHEN c_nationkey % 5 = 0 THEN 'CA' WHEN c_nationkey % 5 = 1 THEN NULL ELSE 'US' END AS Country",
    "CASE WHEN c_custkey % 11 = 0 THEN 'ABCDE' WHEN c_custkey % 11 = 1 THEN concat(10000 + c_custkey % 80000, '-1234') "
    "ELSE concat('', 10000 + c_custkey % 80000) END AS ZipCode",
    "CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN 'T' ELSE 'TX' END AS State",
    "c_acctbal AS Balance",
]
PATIENTS_SQL = "patients AS (SELECT " + ", ".join(PATIENTS) + " FROM customer)"

RAW_PAYLOAD = """concat('{"id":"', o_orderkey, '","name":"', o_orderpriority, '","state":',
  CASE WHEN o_orderkey % 13 = 0 THEN '"Texas"' WHEN o_orderkey % 13 = 1 THEN 'null' ELSE '"TX"' END,
  ',"zipCode":"', 10000 + o_orderkey % 80000, '","private":', CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END,
  ',"created":', CASE WHEN o_orderkey % 29 = 0 THEN 'null' ELSE concat('', 946684800 + o_orderkey * 60) END,
  ',"mood":"', o_orderstatus, '","records":[{"id":"r', o_orderkey,
  '","name":"first","optionData":{"checkBoxes":["a","b"],"data":"d', o_custkey, '","fixedText":true},"priority":', o_orderkey % 10,
  ',"type":"T","color":"red"},{"id":"s', o_orderkey, '","name":"second","type":"U"}]}')"""

PATIENT_FEED = [
    "o_orderkey",
    "raw",
    "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('P', o_custkey) END AS ID",
    "concat('S', o_custkey % 4) AS Shard",
    "concat('B', o_custkey % 50) AS BusinessID",
    "concat('', o_orderkey) AS Created",
    "concat('', o_orderkey + 1) AS Updated",
    "CASE WHEN o_orderkey % 2 = 0 THEN concat('\"', replace(raw, '\"', '\"\"'), '\"') ELSE raw END AS D",
    "CASE WHEN o_orderkey % 11 = 0 THEN 'delete' WHEN o_orderkey % 7 = 0 THEN 'update_preimage' "
    "WHEN o_orderkey % 3 = 0 THEN 'update_postimage' ELSE 'insert' END AS _change_type",
    "o_orderkey AS _commit_version",
    "o_orderdate AS _commit_timestamp",
]
PATIENT_FEED_SQL = (
    f"feed AS (SELECT {', '.join(PATIENT_FEED)} FROM (SELECT *, {RAW_PAYLOAD} AS raw FROM orders) AS o)"
)
