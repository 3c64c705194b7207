"""Views and table functions, for users who query with SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.relational import batch_summary, flagged_transactions


#: Shares an hour is cut into where a batch ends inside it.
_SHARES = 64


def register_views(spark: SparkSession, txns: DataFrame, scores: DataFrame) -> None:
    """``transactions``, ``scoring_results``, ``v_flagged_transactions``, ``v_batch_summary``."""
    txns.createOrReplaceTempView("transactions")
    scores.createOrReplaceTempView("scoring_results")
    flagged_transactions(txns, scores).createOrReplaceTempView("v_flagged_transactions")
    # views must follow their tables, so their plans are lazy throughout
    batch_summary(scores, live=True).createOrReplaceTempView("v_batch_summary")


def register_functions(spark: SparkSession) -> None:
    """SQL table functions over the views: one card's velocity, and the unscored batch.

    They are plain SQL bodies, so filters and limits around a call are planned with it. For many
    lookups at once use :func:`riskloom.operators.relational.card_velocity`.
    """
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION get_card_velocity(
          p_card_id STRING, p_reference_time TIMESTAMP, p_window_hours INT DEFAULT 24)
        RETURNS TABLE (txn_count_window BIGINT, total_amount_window DECIMAL(18,2),
          avg_amount_window DECIMAL(18,2), distinct_merchants BIGINT, distinct_countries BIGINT)
        RETURN SELECT count(*), CAST(coalesce(sum(amount), 0) AS DECIMAL(18,2)),
          CAST(coalesce(avg(amount), 0) AS DECIMAL(18,2)),
          count(DISTINCT merchant_id), count(DISTINCT billing_country)
        FROM transactions
        WHERE card_id = p_card_id
          AND timestamp >= timestampadd(HOUR, -p_window_hours, p_reference_time)
          AND timestamp < p_reference_time
        """
    )
    # The cut is found from counts per hour; only the hour it falls into is ranked, and of that no
    # more than the batch size per hash share, so no task ever holds the table or the hour.
    columns = spark.table("transactions").schema.fields
    names = ", ".join(f"`{f.name}`" for f in columns)
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION extract_unscored_batch(
          p_batch_size INT DEFAULT 10000, p_data_source STRING DEFAULT NULL)
        RETURNS TABLE ({typed})
        RETURN WITH waiting AS (
          SELECT *, date_trunc('HOUR', timestamp) AS _hour
          FROM transactions LEFT ANTI JOIN scoring_results USING (transaction_id)
          WHERE p_data_source IS NULL OR data_source = p_data_source),
        hours AS (
          SELECT _hour, n, sum(n) OVER (ORDER BY _hour) AS upto
          FROM (SELECT _hour, count(*) AS n FROM waiting GROUP BY _hour)),
        placed AS (
          SELECT w.*, h.upto, h.upto - h.n AS earlier
          FROM waiting w JOIN hours h ON w._hour <=> h._hour
          WHERE h.upto - h.n < p_batch_size),
        cut AS (
          SELECT * FROM (
            SELECT *, row_number() OVER (
              PARTITION BY _hour, pmod(xxhash64(transaction_id), {_SHARES}) ORDER BY timestamp, transaction_id) AS _nth
            FROM placed WHERE upto > p_batch_size)
          WHERE _nth <= p_batch_size),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY _hour ORDER BY timestamp, transaction_id) AS _place FROM cut)
        SELECT {names} FROM placed WHERE upto <= p_batch_size
        UNION ALL
        SELECT {names} FROM ranked WHERE earlier + _place <= p_batch_size
        """
    )
