"""The external card dataset: CSV layout, identity join, mapping to the canonical schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Named columns that are always read, and prefixes of numbered column families.
NAMED_COLUMNS = [
    "TransactionID",
    "TransactionDT",
    "TransactionAmt",
    "ProductCD",
    "card1",
    "card4",
    "card6",
    "addr1",
    "addr2",
    "P_emaildomain",
    "R_emaildomain",
    "DeviceType",
    "DeviceInfo",
    "isFraud",
]
FAMILY_PREFIXES = ("C", "D", "V", "M")
PASSED_PREFIXES = ("V", "C", "D")

# Decoding tables.
CARD_TYPES = {
    "visa": "VISA",
    "mastercard": "MASTERCARD",
    "american express": "AMEX",
    "discover": "DISCOVER",
}
PRODUCT_CATEGORIES = {
    "W": "digital_goods",
    "H": "home",
    "C": "clothing",
    "S": "services",
    "R": "retail",
}
COUNTRIES = {87: "USA", 60: "CAN"}
REFERENCE_DATE = "2017-11-30 00:00:00"

_TYPES = {
    "TransactionID": T.LongType(),
    "TransactionDT": T.LongType(),
    "TransactionAmt": T.DoubleType(),
    "addr1": T.DoubleType(),
    "addr2": T.DoubleType(),
    "isFraud": T.IntegerType(),
}
_TEXT = set(NAMED_COLUMNS) - set(_TYPES)


def _wanted(column: str) -> bool:
    return column in NAMED_COLUMNS or column.startswith(FAMILY_PREFIXES)


def _type(column: str) -> T.DataType:
    if column in _TYPES:
        return _TYPES[column]
    return T.StringType() if column in _TEXT or column.startswith("M") else T.DoubleType()


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the wanted columns of a transactions CSV with declared types.

    Only the header line is looked at to learn the column names; nothing is inferred from the data.
    The parser skips the columns that are not selected.
    """
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, _type(n)) for n in names])
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.select(*[n for n in names if _wanted(n)])


def read_identity_csv(spark: SparkSession, path: str) -> DataFrame:
    """Identity columns as text, the key as a number."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType(
        [T.StructField(n, T.LongType() if n == "TransactionID" else T.StringType()) for n in names]
    )
    return spark.read.schema(schema).option("header", True).csv(path)


def join_identity(txns: DataFrame, identity: DataFrame | None) -> DataFrame:
    return txns if identity is None else txns.join(identity, "TransactionID", "left")


def _decoded(values: dict[str, str], key: Column, default: str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def _or_unknown(df: DataFrame, column: str) -> Column:
    unknown = F.lit("unknown")
    return F.coalesce(F.col(column), unknown) if column in df.columns else unknown


def to_canonical(txns: DataFrame, identity: DataFrame | None = None) -> DataFrame:
    """The external layout in canonical columns, with its number families carried along.

    A missing device text reads as ``nan``, as it does in the source's own text form.
    """
    df = join_identity(txns, identity)
    card = F.concat(F.lit("ieee_card_"), F.coalesce(F.col("card1").cast("string"), F.lit("nan")))
    product = F.col("ProductCD")
    category = _decoded(PRODUCT_CATEGORIES, product, "unknown")
    if "addr2" in df.columns:
        country = F.lit("OTHER")
        for code, name in COUNTRIES.items():
            country = F.when(F.col("addr2") == code, name).otherwise(country)
    else:
        country = F.lit("USA")
    start_us = F.unix_micros(F.lit(REFERENCE_DATE).cast("timestamp"))
    seconds = F.col("TransactionDT").cast("bigint")
    if "DeviceType" in df.columns and "DeviceInfo" in df.columns:
        device = F.concat(F.lit("ieee_device_"), F.coalesce(F.col("DeviceInfo"), F.lit("nan")))
    elif "DeviceType" in df.columns:
        device = F.lit("ieee_device_unknown")
    else:
        device = F.lit("unknown")
    passed = [c for p in PASSED_PREFIXES for c in df.columns if c.startswith(p)]
    return df.select(
        F.concat(F.lit("ieee_"), F.col("TransactionID").cast("string")).alias("transaction_id"),
        F.timestamp_micros(start_us + seconds * 1_000_000).alias("timestamp"),
        F.bround("TransactionAmt", 2).alias("amount"),
        F.lit("USD").alias("currency"),
        card.alias("card_id"),
        _decoded(CARD_TYPES, F.lower("card4"), "UNKNOWN").alias("card_type"),
        country.alias("billing_country"),
        country.alias("card_country"),
        country.alias("shipping_country"),
        F.concat(F.lit("ieee_merchant_"), F.coalesce(product, F.lit("nan"))).alias("merchant_id"),
        category.alias("merchant_category"),
        _or_unknown(df, "P_emaildomain").alias("email_domain"),
        F.lit(True).alias("is_online"),
        device.alias("device_id"),
        card.alias("customer_id"),
        F.lit(None).cast("string").alias("ip_address"),
        category.alias("product_category"),
        F.lit("IEEE_CIS").alias("data_source"),
        (F.col("isFraud") == 1).alias("is_fraud"),
        F.lit("GROUND_TRUTH").alias("fraud_label_source"),
        *[F.col(c).alias(f"ieee_{c.lower()}") for c in passed],
    )
