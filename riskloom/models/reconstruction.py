"""Reconstruction-error scorer.

A linear autoencoder with squared loss learns the subspace of the leading principal components
(Baldi and Hornik, 1989), so the model is fitted as a distributed PCA and a row is scored by what
the subspace cannot reproduce.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.expressions import unit
from riskloom.models.forest import (
    TOP_SCHEMA,
    feature_columns,
    feature_rows,
    standardised,
    standardiser,
    top_entries,
    with_floor,
)
from riskloom.operators.cumulative import exact_percentiles
from riskloom.session import checkpointed

_STD_FLOOR = 1e-8


@dataclass
class ReconstructionModel:
    bottleneck: int = 16
    threshold_percentile: float = 98.0
    validation_split: float = 0.1
    row_id: str = "transaction_id"
    features: list[str] = field(default_factory=list)
    scaler: pd.DataFrame | None = None
    loadings: np.ndarray | None = None
    threshold: float = 0.0
    validation_loss: float | None = None

    def fit(
        self, df: DataFrame, features: list[str], stats: pd.DataFrame | None = None
    ) -> ReconstructionModel:
        """Normalise, hold out a share of the ids, learn the subspace, set the error threshold.

        ``stats`` is an earlier ``standardiser`` result with floor 0.
        """
        self.features = list(features)
        stats = standardiser(df, self.features, 0.0) if stats is None else stats
        self.scaler = with_floor(stats, _STD_FLOOR)
        held = unit(F.lit("held-out"), self.row_id) < self.validation_split
        marked = df.select(self.row_id, *self.features, held.alias("_held"))
        train = marked.where(~F.col("_held"))
        scaled = train.select(*[z.alias(n) for n, z in standardised(self.scaler)])
        vectors = VectorAssembler(inputCols=self.features, outputCol="_x").transform(scaled)
        k = max(1, min(self.bottleneck, len(self.features) - 1))
        model = PCA(k=k, inputCol="_x", outputCol="_pc").fit(vectors.select("_x"))
        self.loadings = model.pc.toArray()
        # written once: the threshold and the loss both read it
        scored = checkpointed(self.errors(marked).select("_held", "reconstruction_error"))
        errors = scored.where(~F.col("_held")).select("reconstruction_error")
        point = exact_percentiles(
            errors, [], "reconstruction_error", {"threshold": self.threshold_percentile / 100}
        ).first()
        self.threshold = float(point["threshold"]) if point else 0.0
        loss = scored.where("_held").agg(F.avg("reconstruction_error")).first()[0]
        self.validation_loss = None if loss is None else float(loss)
        return self

    def _squares(self):
        """Squared residuals of a batch of feature rows."""
        mean, std = self.scaler["mean"].to_numpy(), self.scaler["std"].to_numpy()
        w = self.loadings  # features x components

        def squares(columns: Sequence[pa.Array]) -> np.ndarray:
            x = (feature_rows(columns) - mean) / std
            return (x - (x @ w) @ w.T) ** 2

        return squares

    def _apply(self, df: DataFrame, kind: str, name: str) -> DataFrame:
        """Run the small matrix product in Arrow batches; only the feature columns are sent. NaN comes back as NULL."""
        mean, std = self.scaler["mean"].to_numpy(), self.scaler["std"].to_numpy()
        w, squares = self.loadings, self._squares()

        def lists(rows: np.ndarray) -> pa.Array:
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), from_pandas=True))

        @F.arrow_udf("array<double>")
        def squared(*columns: pa.Array) -> pa.Array:
            return lists(squares(columns))

        @F.arrow_udf("array<double>")
        def encode(*columns: pa.Array) -> pa.Array:
            return lists(((feature_rows(columns) - mean) / std) @ w)

        if kind == "error":
            return df.withColumn(name, self.error_column())
        return df.withColumn(name, {"squared": squared, "encode": encode}[kind](*feature_columns(self.features)))

    def error_column(self) -> Column:
        """The mean squared residual."""
        squares = self._squares()

        @F.arrow_udf("double")
        def error(*columns: pa.Array) -> pa.Array:
            return pa.array(squares(columns).mean(axis=1), from_pandas=True)

        return error(*feature_columns(self.features))

    def top_column(self, k: int, above: float) -> Column:
        """What :func:`top_residuals` takes, of residuals greater than ``above``, found in Arrow batches."""
        squares, features = self._squares(), self.features

        @F.arrow_udf(TOP_SCHEMA)
        def top(*columns: pa.Array) -> pa.Array:
            values = squares(columns)
            return top_entries(values, values > above, features, k)

        return top(*feature_columns(features))

    def errors(self, df: DataFrame) -> DataFrame:
        """Add the mean squared residual."""
        return self._apply(df, "error", "reconstruction_error")

    def residuals(self, df: DataFrame, name: str = "residuals") -> DataFrame:
        """Add the squared residual of every feature, in feature order."""
        return self._apply(df, "squared", name)

    def encode(self, df: DataFrame, name: str = "latent") -> DataFrame:
        """Add the position in the learned subspace."""
        return self._apply(df, "encode", name)

    def score(self, df: DataFrame, name: str = "autoencoder_score") -> DataFrame:
        """Add the error scaled so that the threshold lands on one half, cut to [0, 1]."""
        out = self.errors(df)
        return out.withColumn(name, scaled_error("reconstruction_error", self.threshold)).drop(
            "reconstruction_error"
        )

    def score_with_residuals(self, df: DataFrame, residuals: str = "residuals") -> DataFrame:
        """Score and residuals from one pass through Python."""
        out = self.residuals(df, residuals)
        total = F.aggregate(residuals, F.lit(0.0), lambda a, x: a + x)
        return out.withColumn("_error", total / len(self.features)).withColumn(
            "autoencoder_score", scaled_error("_error", self.threshold)
        ).drop("_error")

    def save(self, spark: SparkSession, path: str) -> None:
        table = self.scaler[["feature", "mean", "std"]].assign(
            position=range(len(self.features)), loadings=[r.tolist() for r in self.loadings]
        )
        schema = "feature string, mean double, std double, position int, loadings array<double>"
        spark.createDataFrame(table, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/subspace")
        facts = [(self.bottleneck, self.threshold_percentile, self.threshold, self.validation_loss)]
        facts_schema = "bottleneck int, threshold_percentile double, threshold double, validation_loss double"
        spark.createDataFrame(facts, facts_schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ReconstructionModel:
        table = spark.read.parquet(f"{path}/subspace").toPandas().sort_values("position")
        facts = spark.read.parquet(f"{path}/facts").first()
        return cls(
            bottleneck=facts["bottleneck"],
            threshold_percentile=facts["threshold_percentile"],
            features=table["feature"].tolist(),
            scaler=table[["feature", "mean", "std"]].reset_index(drop=True),
            loadings=np.array(table["loadings"].tolist()),
            threshold=facts["threshold"],
            validation_loss=facts["validation_loss"],
        )


def scaled_error(error: str, threshold: float) -> Column:
    """Error over twice the threshold in [0, 1]; with threshold 0 any error scores 1."""
    if threshold <= 0:
        return F.when(F.col(error) > 0, 1.0).otherwise(0.0)
    return F.least(F.greatest(F.col(error) / F.lit(2.0 * threshold), F.lit(0.0)), F.lit(1.0))


def predicted(score: str, threshold: float | None = None) -> Column:
    """1 where the score reaches the threshold; none (or 0) means one half."""
    return F.when(F.col(score) >= (threshold or 0.5), 1).otherwise(0)


def top_residuals(residuals: str, features: list[str], k: int = 5) -> Column:
    """The k largest squared residuals as (value, position, feature); ties: the later column first."""
    names = F.array(*[F.lit(f) for f in features])
    entries = F.transform(
        residuals,
        lambda v, i: F.struct(
            v.alias("value"), i.alias("position"), F.get(names, i).alias("feature")
        ),
    )
    return F.slice(F.sort_array(entries, asc=False), 1, k)
