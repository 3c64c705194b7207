"""Data-quality suites, each evaluated in one aggregation pass."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

REQUIRED_COLUMNS = ["transaction_id", "timestamp", "amount", "merchant_id", "card_id"]
AMOUNT_RANGE = (0, 1_000_000)

# The expectation suite, in order.
_EXISTS = "expect_column_to_exist"
_NOT_NULL = "expect_column_values_to_not_be_null"
_UNIQUE = "expect_column_values_to_be_unique"
_BETWEEN = "expect_column_values_to_be_between"
SUITE = [
    (_EXISTS, "transaction_id"),
    (_NOT_NULL, "transaction_id"),
    (_UNIQUE, "transaction_id"),
    (_EXISTS, "amount"),
    (_NOT_NULL, "amount"),
    (_BETWEEN, "amount"),
    (_EXISTS, "timestamp"),
    (_NOT_NULL, "timestamp"),
    (_EXISTS, "card_id"),
    (_NOT_NULL, "card_id"),
    (_EXISTS, "merchant_id"),
    (_NOT_NULL, "merchant_id"),
]


class ValidationFailed(ValueError):
    """Raised in strict mode; carries the failed expectations."""


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in REQUIRED_COLUMNS if c not in df.columns]


def _counters(df: DataFrame) -> DataFrame:
    """All counts of both suites as one row, from one pass.

    Rows are counted by id first (partial counts leave each map task once per id), so that
    uniqueness and everything else come from the same aggregation.
    """
    present = df.columns
    counts = [F.count("*").alias("rows")]
    counts += [
        F.sum(F.col(c).isNull().cast("bigint")).alias(f"null_{c}") for c in REQUIRED_COLUMNS if c in present
    ]
    if "amount" in present:
        amount = F.col("amount").cast("double")
        out = (amount < AMOUNT_RANGE[0]) | (amount > AMOUNT_RANGE[1])
        counts.append(F.sum(F.coalesce(out, F.lit(False)).cast("bigint")).alias("outside"))
    if "transaction_id" not in present:
        one = df.agg(*counts)
        return one.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in one.columns])
    per_id = df.groupBy("transaction_id").agg(*counts)
    known = F.col("transaction_id").isNotNull()
    names = [c for c in per_id.columns if c != "transaction_id"]
    return per_id.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
        F.count("*").alias("ids"),
        F.coalesce(F.sum(F.when(known & (F.col("rows") > 1), F.col("rows"))), F.lit(0)).alias("repeated"),
    )


def _rows(counters: DataFrame, entries: list[tuple[str, str, Column]]) -> DataFrame:
    """One row per (expectation, column, unexpected count) from a one-row counter table."""
    line = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(e).alias("expectation"),
                    F.lit(c).alias("column"),
                    n.cast("bigint").alias("unexpected_count"),
                )
                for i, (e, c, n) in enumerate(entries)
            ]
        )
    ).alias("r")
    return counters.select(line).select(
        "r.position",
        "r.expectation",
        "r.column",
        "r.unexpected_count",
        (F.col("r.unexpected_count") == 0).alias("success"),
    )


def _expectations(present: list[str]) -> list[tuple[str, str, Column]]:
    def unexpected(expectation: str, column: str) -> Column:
        if column not in present:
            return F.lit(1)
        if expectation == _EXISTS:
            return F.lit(0)
        if expectation == _NOT_NULL:
            return F.col(f"null_{column}")
        return F.col("repeated") if expectation == _UNIQUE else F.col("outside")

    return [(e, c, unexpected(e, c)) for e, c in SUITE]


def _basic_checks(present: list[str]) -> list[tuple[str, str, Column]]:
    entries = [("column_exists", c, F.lit(0 if c in present else 1)) for c in REQUIRED_COLUMNS]
    if "transaction_id" in present:
        entries += [
            ("no_null_transaction_ids", "transaction_id", F.col("null_transaction_id")),
            ("unique_transaction_ids", "transaction_id", F.col("rows") - F.col("ids")),
        ]
    if "amount" in present:
        entries += [
            ("valid_amount_range", "amount", F.col("outside")),
            ("no_null_amounts", "amount", F.col("null_amount")),
        ]
    return entries


def expectation_suite(df: DataFrame) -> DataFrame:
    """The twelve expectations with unexpected counts.

    Uniqueness counts every row of a repeated non-null id. An expectation on a missing column fails.
    """
    return _rows(_counters(df), _expectations(df.columns))


def basic_suite(df: DataFrame) -> DataFrame:
    """Column checks, NULL and duplicate ids, amounts out of range or missing.

    Duplicates are rows beyond the first of each id, NULL counting as one id.
    """
    return _rows(_counters(df), _basic_checks(df.columns))


def validate(
    df: DataFrame, batch_id: str, *, suite: str = "expectations", strict: bool = False
) -> dict:
    """Run a suite and return its outcome; ``strict`` raises when anything failed.

    One pass; only the suite's own dozen result rows, and the row count, reach the driver.
    """
    chosen = _expectations if suite == "expectations" else _basic_checks
    entries_and_count = [*chosen(df.columns), ("rows", "", F.col("rows"))]
    rows: list[Row] = _rows(_counters(df), entries_and_count).orderBy("position").collect()
    n_rows = rows.pop()["unexpected_count"]
    entries = [
        {
            "expectation": r["expectation"],
            "column": r["column"],
            "unexpected_count": r["unexpected_count"],
            "success": r["success"],
        }
        for r in rows
    ]
    failed = [e for e in entries if not e["success"]]
    missing = missing_columns(df)
    if missing:
        failed.insert(
            0,
            {
                "expectation": "columns_present",
                "column": ",".join(missing),
                "unexpected_count": len(missing),
                "success": False,
            },
        )
    result = {
        "batch_id": batch_id,
        "timestamp": datetime.now(timezone.utc).isoformat(),
        "n_rows": n_rows,
        "success": not failed,
        "expectations": entries,
        "failed_expectations": failed,
    }
    if strict and failed:
        raise ValidationFailed(f"validation failed: {failed}")
    return result


_RESULT_SCHEMA = (
    "batch_id string, timestamp string, n_rows bigint, success boolean, "
    "expectations array<struct<expectation:string,column:string,unexpected_count:bigint,success:boolean>>, "
    "failed_expectations array<struct<expectation:string,column:string,unexpected_count:bigint,success:boolean>>"
)


def save_result(spark, result: dict, path: str) -> None:
    """Append a validation outcome to a JSON table."""
    spark.createDataFrame([result], _RESULT_SCHEMA).write.mode("append").json(path)


def validation_summary(spark, path: str, batch_ids: list[str] | None = None) -> DataFrame:
    """One line per saved outcome, optionally for some batches only."""
    saved = spark.read.schema(_RESULT_SCHEMA).json(path)
    if batch_ids is not None:
        saved = saved.where(F.col("batch_id").isin(batch_ids))
    return saved.select(
        "batch_id",
        "timestamp",
        "n_rows",
        "success",
        F.size("expectations").alias("n_expectations"),
        F.size("failed_expectations").alias("n_failed"),
    )


def batch_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: NULL rate, and for numbers mean, deviation, minimum and maximum."""
    names = columns or [c for c in df.columns]
    numeric = {
        f.name for f in df.schema.fields if f.dataType.typeName() in {"double", "float", "integer", "long", "decimal"}
    }
    aggregates = []
    for i, c in enumerate(names):
        x = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        aggregates += [
            F.avg(F.col(c).isNull().cast("double")).alias(f"null{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
    one = df.agg(*aggregates)
    line = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"null{i}").alias("null_rate"),
                    *[F.col(f"{s}{i}").alias(s) for s in ("mean", "std", "min", "max")],
                )
                for i, c in enumerate(names)
            ]
        )
    )
    return one.select(line.alias("r")).select("r.*")


def batch_quality(df: DataFrame) -> DataFrame:
    """Rows, duplicate rate of the ids, and whether all required columns are there."""
    per_id = df.groupBy("transaction_id").agg(F.count("*").alias("_n"))
    return per_id.agg(
        F.sum("_n").alias("rows"),
        ((F.sum("_n") - F.count("*")) / F.sum("_n")).alias("duplicate_rate"),
        F.lit(not missing_columns(df)).alias("schema_ok"),
    )
