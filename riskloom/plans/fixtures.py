"""The given tables seen as transaction tables.

Column lists are plain SQL that Spark and DuckDB both accept, so a query and its oracle read the
same views. :class:`Tables` builds the Spark side, :func:`with_views` the oracle side.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import configure

TXN_ID = "concat('txn_', lpad(cast(event_id as varchar(20)), 10, '0'))"

_TXN = f"""
{TXN_ID} AS transaction_id,
ts AS timestamp,
round(value * 25, 2) AS amount,
'USD' AS currency,
concat('m_', cast(event_id % 40 as varchar(20))) AS merchant_id,
CASE event_type WHEN 'click' THEN 'grocery' WHEN 'view' THEN 'electronics' WHEN 'purchase' THEN 'travel' WHEN 'signup' THEN 'food_beverage' ELSE 'gambling' END AS merchant_category,
CASE WHEN event_id % 101 = 0 THEN NULL ELSE concat('card_', cast(cast(floor(user_id / 10.0) as bigint) as varchar(20))) END AS card_id,
CASE user_id % 4 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTERCARD' WHEN 2 THEN 'AMEX' ELSE 'DISCOVER' END AS card_type,
CASE WHEN user_id % 11 = 0 THEN 'CAN' ELSE 'USA' END AS card_country,
concat('cust_', cast(user_id as varchar(20))) AS customer_id,
concat('device_', substr(md5(cast(user_id as varchar(20))), 1, 8)) AS device_id,
CASE WHEN event_id % 17 = 0 THEN 'tempmail.com' WHEN event_id % 19 = 0 THEN 'yopmail.com' WHEN event_id % 23 = 0 THEN NULL ELSE 'gmail.com' END AS email_domain,
CASE WHEN event_id % 29 = 0 THEN NULL ELSE 'USA' END AS billing_country,
CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'GBR' ELSE 'USA' END AS shipping_country,
event_id % 3 <> 0 AS is_online,
'SYNTHETIC' AS data_source,
(event_type = 'error' AND value > 100) AS is_fraud,
'INJECTED' AS fraud_label_source
"""

# Orders have day-granular times: many rows of a customer share one timestamp.
_ORDER_TXN = """
concat('ord_', lpad(cast(o_orderkey as varchar(20)), 10, '0')) AS transaction_id,
o_orderdate AS timestamp,
round(o_totalprice / 25, 2) AS amount,
concat('m_', o_orderpriority) AS merchant_id,
concat('card_', cast(o_custkey as varchar(20))) AS card_id
"""

_EXT_TXN = """
o_orderkey AS TransactionID,
o_orderkey * 61 + 86400 AS TransactionDT,
o_totalprice / 7 AS TransactionAmt,
CASE o_orderkey % 6 WHEN 0 THEN 'W' WHEN 1 THEN 'H' WHEN 2 THEN 'C' WHEN 3 THEN 'S' WHEN 4 THEN 'R' ELSE 'Z' END AS ProductCD,
cast(o_custkey as varchar(20)) AS card1,
CASE o_custkey % 5 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'American Express' WHEN 3 THEN 'discover' ELSE NULL END AS card4,
CASE o_orderkey % 4 WHEN 0 THEN cast(87 as double) WHEN 1 THEN cast(60 as double) WHEN 2 THEN cast(96 as double) ELSE NULL END AS addr2,
CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'gmail.com' END AS P_emaildomain,
CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS isFraud,
o_totalprice / 100 AS V1,
cast(o_orderkey % 10 as double) AS C1,
cast(o_orderkey % 31 as double) AS D1,
'T' AS M1
"""

# Only finished orders have identity data, so the join to it is a real outer join.
_EXT_IDENTITY = """
o_orderkey AS TransactionID,
CASE WHEN o_orderkey % 2 = 0 THEN 'desktop' ELSE 'mobile' END AS DeviceType,
CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE 'Windows' END AS DeviceInfo
"""
_EXT_IDENTITY_ROWS = "o_orderstatus = 'F'"

# Scores of every transaction but the sign-ups, which are the ones still to be scored.
_SCORES = f"""
{TXN_ID} AS transaction_id,
concat('batch_', cast(event_id % 7 as varchar(20))) AS batch_id,
ts + interval 1 hour AS scored_at,
cast((event_id * 7919) % 10000 as double) / 10000 AS ensemble_score,
cast((event_id * 104729) % 10000 as double) / 10000 AS rule_score,
cast((event_id * 1299709) % 10000 as double) / 10000 AS isolation_forest_score,
cast(NULL as double) AS autoencoder_score,
(event_id * 7919) % 10000 >= 5000 AS is_flagged
"""
_SCORES_ROWS = "event_type <> 'signup'"

_AUDIT = """
ts AS timestamp,
concat('batch_', cast(event_id % 7 as varchar(20))) AS batch_id,
CASE event_id % 6 WHEN 0 THEN 'EXTRACT' WHEN 1 THEN 'VALIDATE' WHEN 2 THEN 'TRANSFORM' WHEN 3 THEN 'SCORE' WHEN 4 THEN 'PERSIST' ELSE 'ALERT' END AS operation,
CASE user_id % 3 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
event_id AS records_processed,
value AS duration_seconds
"""

_DQ = """
CASE WHEN l_linenumber = 7 AND l_orderkey % 50 = 0 THEN NULL ELSE concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20))) END AS transaction_id,
l_shipdate AS timestamp,
CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN -l_extendedprice WHEN l_orderkey % 83 = 0 THEN l_extendedprice * 1000 ELSE l_extendedprice END AS amount,
concat('m_', cast(l_suppkey as varchar(20))) AS merchant_id,
concat('card_', cast(l_partkey as varchar(20))) AS card_id
"""

_VIEWS = {
    "txn": (_TXN, "events", None),
    "order_txn": (_ORDER_TXN, "orders", None),
    "ext_txn": (_EXT_TXN, "orders", None),
    "ext_identity": (_EXT_IDENTITY, "orders", _EXT_IDENTITY_ROWS),
    "scores": (_SCORES, "events", _SCORES_ROWS),
    "audit_log": (_AUDIT, "events", None),
    "dq_txn": (_DQ, "lineitem", None),
}


def _select(name: str) -> str:
    columns, table, rows = _VIEWS[name]
    return f"SELECT {columns} FROM {table}" + (f" WHERE {rows}" if rows else "")


def with_views(body: str, *names: str) -> str:
    """``body`` with the named views in front of it as common table expressions."""
    ctes = [f"{n} AS ({_select(n)})" for n in names]
    text = body.strip()
    if text.upper().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + text[5:]
    return "WITH " + ", ".join(ctes) + " " + text


class Tables:
    """Lazily built views over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder

    def _view(self, name: str) -> DataFrame:
        columns, table, rows = _VIEWS[name]
        source = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        if rows:
            source = source.where(rows)
        picked = [line.rstrip().rstrip(",") for line in columns.strip().splitlines()]
        out = source.selectExpr(*picked)
        for column in ("timestamp", "scored_at"):
            if column in out.columns:
                out = out.withColumn(column, F.col(column).cast("timestamp"))
        return out

    def _money(self, name: str) -> DataFrame:
        """Amounts are rounded to cents in the view, so the cast to DECIMAL changes no value."""
        return self._view(name).withColumn("amount", F.col("amount").cast("decimal(18,2)"))

    @cached_property
    def txn(self) -> DataFrame:
        return self._money("txn")

    @cached_property
    def order_txn(self) -> DataFrame:
        return self._money("order_txn")

    @cached_property
    def ext_txn(self) -> DataFrame:
        return self._view("ext_txn")

    @cached_property
    def ext_identity(self) -> DataFrame:
        return self._view("ext_identity")

    @cached_property
    def scores(self) -> DataFrame:
        return self._view("scores")

    @cached_property
    def audit_log(self) -> DataFrame:
        return self._view("audit_log")

    @cached_property
    def dq_txn(self) -> DataFrame:
        return self._view("dq_txn")
