"""Weighted combination of the scorers, with the five strongest reasons per row."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.models.forest import IsolationForest, standardiser
from riskloom.models.reconstruction import ReconstructionModel, scaled_error
from riskloom.models.rules import RuleScorer, reason_struct
from riskloom.session import checkpointed

# Default weights and model versions.
DEFAULT_WEIGHTS = {"rules": 0.30, "isolation_forest": 0.35, "autoencoder": 0.35}
VERSION = "1.0.0"

_SIGNIFICANT = 0.1
_KEPT_REASONS = 5
_PER_MODEL = 3


def redistribute(weights: dict[str, float], missing: str) -> dict[str, float]:
    """Weights with the missing model's share handed to the others in proportion."""
    rest = sum(w for m, w in weights.items() if m != missing)
    if rest <= 0:
        raise ValueError("no weight left")
    return {m: 0.0 if m == missing else w / rest for m, w in weights.items()}


def combined(weights: dict[str, float], present: list[str]) -> Column:
    """Weighted sum of the score columns that exist, cut to [0, 1]."""
    columns = {
        "rules": "rule_score",
        "isolation_forest": "isolation_forest_score",
        "autoencoder": "autoencoder_score",
    }
    total = F.lit(0.0)
    for model, column in columns.items():
        if column in present and weights.get(model):
            total = total + F.col(column) * F.lit(weights[model])
    return F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))


def _model_reasons(entries: Column, model: str, value_field: str, text: str) -> Column:
    """Reasons from (value, feature) entries above the significance limit."""
    kept = F.filter(entries, lambda e: e["value"] > _SIGNIFICANT)
    head, tail = text.split("{}")
    return F.transform(
        kept,
        lambda e: reason_struct(
            model=F.lit(model),
            feature=e["feature"],
            reason=F.concat(F.lit(head), e["feature"], F.lit(tail)),
            **{value_field: F.round(e["value"], 4)},
        ),
    )


def forest_reasons(entries: Column) -> Column:
    return _model_reasons(
        entries, "isolation_forest", "contribution", "Feature '{}' contributed to anomaly score"
    )


def reconstruction_reasons(entries: Column) -> Column:
    return _model_reasons(
        entries, "autoencoder", "reconstruction_error", "High reconstruction error for '{}'"
    )


def strongest(reasons: Column, k: int = _KEPT_REASONS) -> Column:
    """The first k by score, else contribution, else 0; equal ones keep their order."""
    keyed = F.transform(
        reasons,
        lambda r, i: F.struct(
            F.coalesce(r["score"], r["contribution"], F.lit(0.0)).alias("weight"),
            (-i).alias("order"),
            r.alias("reason"),
        ),
    )
    return F.transform(F.slice(F.sort_array(keyed, asc=False), 1, k), lambda e: e["reason"])


@dataclass
class EnsembleScorer:
    weights: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
    flag_threshold: float = 0.5
    use_autoencoder: bool = True
    calibration: str = "batch"
    rules: RuleScorer = field(default_factory=RuleScorer)
    forest: IsolationForest | None = None
    reconstruction: ReconstructionModel | None = None
    features: list[str] = field(default_factory=list)

    @property
    def model_versions(self) -> dict[str, str]:
        versions = {"ensemble": VERSION, "rules": VERSION}
        if self.forest is not None:
            versions["isolation_forest"] = VERSION
        if self.reconstruction is not None:
            versions["autoencoder"] = VERSION
        return versions

    def fit(self, df: DataFrame, features: list[str], **forest_options) -> EnsembleScorer:
        """Fit on a feature table (write it first: fitting reads it several times)."""
        self.features = list(features)
        stats = standardiser(df, self.features, 0.0)
        self.forest = IsolationForest(**forest_options).fit(df, self.features, stats)
        self.forest.calibrate(df)
        if self.use_autoencoder and len(self.features) > 1:
            self.reconstruction = ReconstructionModel().fit(df, self.features, stats)
        else:
            self.weights = redistribute(self.weights, "autoencoder")
        return self

    def score(self, df: DataFrame) -> DataFrame:
        """All scores, the flag and the ``reasons`` array; the input columns stay."""
        if self.forest is None:
            raise ValueError("fit() or load() first")
        # one select, so that the features go to Python once
        from_models = {"_contributions": self.forest.top_contributions(_PER_MODEL, _SIGNIFICANT)}
        if self.reconstruction is not None:
            from_models["_error"] = self.reconstruction.error_column()
            from_models["_residuals"] = self.reconstruction.top_column(_PER_MODEL, _SIGNIFICANT)
        out, raw = self.rules.score(df), self.forest.raw_column(df.sparkSession)
        if self.calibration == "batch":
            # the batch's range needs every raw score before the first result
            out = checkpointed(out.withColumn("_forest_raw", raw))
        else:
            from_models["_forest_raw"] = raw
        out = self.forest.score(out.withColumns(from_models), calibration=self.calibration)
        parts = [F.col("rule_reasons"), forest_reasons(F.col("_contributions"))]
        if self.reconstruction is not None:
            out = out.withColumn("autoencoder_score", scaled_error("_error", self.reconstruction.threshold))
            parts.append(reconstruction_reasons(F.col("_residuals")))
        out = out.withColumn("ensemble_score", combined(self.weights, out.columns))
        out = out.withColumn("is_flagged", F.col("ensemble_score") >= self.flag_threshold)
        out = out.withColumn("reasons", strongest(F.concat(*parts)))
        return out.drop("rule_reasons", *from_models)

    def results(self, scored: DataFrame) -> DataFrame:
        """The scored rows as a result table: scores, flag, reasons and versions as JSON."""
        return result_table(scored, self.model_versions)

    def save(self, spark: SparkSession, path: str) -> None:
        self.forest.save(spark, f"{path}/forest")
        if self.reconstruction is not None:
            self.reconstruction.save(spark, f"{path}/reconstruction")
        config = {
            "weights": self.weights,
            "flag_threshold": self.flag_threshold,
            "use_autoencoder": self.use_autoencoder,
            "has_reconstruction": self.reconstruction is not None,
            "calibration": self.calibration,
            "features": self.features,
            "rules": [
                self.rules.amount_threshold,
                self.rules.velocity_threshold_1h,
                self.rules.velocity_threshold_24h,
            ],
        }
        row = spark.createDataFrame([(json.dumps(config),)], "config string").coalesce(1)
        row.write.mode("overwrite").parquet(f"{path}/config")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> EnsembleScorer:
        config = json.loads(spark.read.parquet(f"{path}/config").first()["config"])
        reconstruction = None
        if config["has_reconstruction"]:
            reconstruction = ReconstructionModel.load(spark, f"{path}/reconstruction")
        return cls(
            weights=config["weights"],
            flag_threshold=config["flag_threshold"],
            use_autoencoder=config["use_autoencoder"],
            calibration=config["calibration"],
            rules=RuleScorer(*config["rules"]),
            forest=IsolationForest.load(spark, f"{path}/forest"),
            reconstruction=reconstruction,
            features=config["features"],
        )


def result_table(scored: DataFrame, versions: dict[str, str]) -> DataFrame:
    pairs = [F.lit(x) for pair in versions.items() for x in pair]
    missing = F.lit(None).cast("double")
    reconstruction = F.col("autoencoder_score") if "autoencoder_score" in scored.columns else missing
    return scored.select(
        "transaction_id",
        "ensemble_score",
        "is_flagged",
        "rule_score",
        "isolation_forest_score",
        reconstruction.alias("autoencoder_score"),
        F.to_json("reasons").alias("reason_codes"),
        F.to_json(F.create_map(*pairs)).alias("model_versions"),
    )
