"""Seven weighted rules with reasons, as column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schema import REASON

# Rule weights.
RULE_WEIGHTS = {
    "high_amount": 0.25,
    "velocity_1h": 0.20,
    "velocity_24h": 0.10,
    "night_activity": 0.10,
    "country_mismatch": 0.15,
    "suspicious_email": 0.10,
    "high_risk_merchant": 0.10,
}

# Messages of the rules that quote no number.
_MESSAGES = {
    "night_activity": "Transaction during unusual hours (1am-5am)",
    "country_mismatch": "Billing and shipping countries do not match",
    "suspicious_email": "Suspicious or disposable email domain detected",
    "high_risk_merchant": "Transaction at high-risk merchant category",
}


def reason_struct(**values: Column) -> Column:
    """A reason with the given fields; the others are NULL and vanish from its JSON."""
    return F.struct(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REASON.fields]
    )


def _unit(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


@dataclass(frozen=True)
class _Rule:
    name: str
    score: Column
    fires: Column
    message: Column

    def reason(self) -> Column:
        return F.when(
            self.fires,
            reason_struct(
                model=F.lit("rules"), rule=F.lit(self.name), score=self.score, reason=self.message
            ),
        )


@dataclass(frozen=True)
class RuleScorer:
    amount_threshold: float = 5000.0
    velocity_threshold_1h: int = 5
    velocity_threshold_24h: int = 20
    night_hours: tuple[int, int] = (1, 5)
    weights: dict[str, float] = field(default_factory=lambda: dict(RULE_WEIGHTS))

    def _rules(self, present: list[str]) -> list[_Rule]:
        """The rules whose columns exist, in their fixed order."""
        amount = F.col("amount").cast("double")
        rules = []
        if "amount" in present:
            over = amount > self.amount_threshold
            curve = _unit(F.log1p(amount / self.amount_threshold) / math.log1p(10))
            limit = f"{self.amount_threshold:.2f}"
            rules.append(
                _Rule(
                    "high_amount",
                    F.when(over, curve).otherwise(curve * 0.3),
                    over,
                    F.format_string(f"Amount $%.2f exceeds threshold ${limit}", amount),
                )
            )
        if "card_txn_count_1h" in present:
            n, limit = F.col("card_txn_count_1h"), self.velocity_threshold_1h
            curve = _unit(F.log1p(n / limit) / math.log1p(5))
            rules.append(
                _Rule(
                    "velocity_1h",
                    F.when(n >= limit, curve).otherwise(curve * 0.5),
                    n >= limit,
                    F.format_string(
                        f"%d transactions in last hour (threshold: {limit})", n.cast("bigint")
                    ),
                )
            )
        if "card_txn_count_24h" in present:
            n, limit = F.col("card_txn_count_24h"), self.velocity_threshold_24h
            curve = _unit(n / limit)
            rules.append(
                _Rule(
                    "velocity_24h",
                    F.when(n >= limit, curve).otherwise(curve * 0.3),
                    n >= limit,
                    F.format_string(
                        f"%d transactions in last 24h (threshold: {limit})", n.cast("bigint")
                    ),
                )
            )
        if "is_night" in present:
            night = F.col("is_night") != 0
            if "amount" in present:
                score = F.when(night & (amount > 500), 0.8).when(night, 0.3).otherwise(0.0)
            else:
                score = F.when(night, 0.5).otherwise(0.0)
            rules.append(self._flagged("night_activity", score, score > 0.3))
        for name, column, value in (
            ("country_mismatch", "country_mismatch", 0.7),
            ("suspicious_email", "suspicious_email", 0.8),
            ("high_risk_merchant", "high_risk_category", 0.5),
        ):
            if column in present:
                on = F.col(column) != 0
                rules.append(self._flagged(name, F.when(on, value).otherwise(0.0), on))
        return rules

    @staticmethod
    def _flagged(name: str, score: Column, fires: Column) -> _Rule:
        return _Rule(name, score, fires, F.lit(_MESSAGES[name]))

    def rule_columns(self, present: list[str]) -> dict[str, Column]:
        """Each rule's own score."""
        return {r.name: r.score for r in self._rules(present)}

    def score(self, features: DataFrame) -> DataFrame:
        """Add ``rule_score`` in [0, 1] and the ordered ``rule_reasons``."""
        rules = self._rules(features.columns)
        total = F.lit(0.0)
        for rule in rules:
            total = total + rule.score * self.weights[rule.name]
        reasons = F.array(*[r.reason() for r in rules]) if rules else F.array()
        return features.select(
            "*",
            _unit(total).alias("rule_score"),
            F.filter(reasons, lambda r: r.isNotNull()).alias("rule_reasons"),
        )

    def catalogue(self, spark: SparkSession) -> DataFrame:
        """Rule names with a description that quotes the configured limits."""
        start, end = self.night_hours
        # Rule descriptions.
        text = {
            "high_amount": f"Transaction amount exceeds ${self.amount_threshold:.0f}",
            "velocity_1h": f"More than {self.velocity_threshold_1h} transactions per hour from same card",
            "velocity_24h": f"More than {self.velocity_threshold_24h} transactions per 24h from same card",
            "night_activity": f"Transaction during unusual hours ({start}:00-{end}:00)",
            "country_mismatch": "Billing and shipping countries do not match",
            "suspicious_email": "Email from known disposable/suspicious domain",
            "high_risk_merchant": "Transaction at high-risk merchant category",
        }
        rows = [(n, text[n], float(self.weights[n])) for n in text]
        return spark.createDataFrame(rows, "rule string, description string, weight double")


def rule_summary(scored: DataFrame) -> DataFrame:
    """Rows, mean rule score, and rows above one half."""
    return scored.agg(
        F.count("*").alias("n_samples"),
        F.avg("rule_score").alias("mean_score"),
        F.coalesce(F.sum((F.col("rule_score") > 0.5).cast("bigint")), F.lit(0)).alias("flagged_count"),
    )
