"""Isolation forest (Liu, Ting and Zhou, 2008) grown and applied by Spark tasks.

Each tree sees a bounded hash sample of the rows, is grown by one small grouped-map call, and comes
back as rows of a node table. Trees hold at most ``2 * max_samples - 1`` nodes, which bounds the
forest that is sent to the executors for scoring, whatever the size of the training table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.relational import top_per_row

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"
)
_EPSILON = 1e-10
#: Rows scored at once, so that their places in all trees stay in a core's cache.
_CHUNK = 256

TOP_SCHEMA = "array<struct<value:double,position:int,feature:string>>"


def standardiser(df: DataFrame, features: list[str], floor: float | None = None) -> pd.DataFrame:
    """Mean and population deviation per feature, from one aggregation.

    With ``floor`` that much is added to every deviation; without, a deviation of 0 becomes 1.
    """
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(features)],
        F.count("*").alias("n"),
    ).first()
    mean = [float(row[f"m{i}"] or 0.0) for i in range(len(features))]
    std = [float(row[f"s{i}"] or 0.0) for i in range(len(features))]
    std = [s or 1.0 for s in std] if floor is None else [s + floor for s in std]
    out = pd.DataFrame({"feature": features, "mean": mean, "std": std})
    out.attrs["n"] = int(row["n"])
    return out


def with_floor(scaler: pd.DataFrame, floor: float | None = None) -> pd.DataFrame:
    """A scaler found with floor 0, as :func:`standardiser` would give it with another floor."""
    out = scaler.copy()
    out["std"] = [s or 1.0 for s in out["std"]] if floor is None else [s + floor for s in out["std"]]
    out.attrs = dict(scaler.attrs)
    return out


def standardised(scaler: pd.DataFrame) -> list[tuple[str, Column]]:
    """(feature, z-score expression) pairs."""
    return [
        (r.feature, (F.col(r.feature).cast("double") - F.lit(r.mean)) / F.lit(r.std))
        for r in scaler.itertuples()
    ]


def feature_columns(features: list[str]) -> list[Column]:
    """What the model functions read; those of one select share the rows sent to Python."""
    return [F.col(c).cast("double") for c in features]


def feature_rows(columns: Sequence[pa.Array]) -> np.ndarray:
    """A batch of :func:`feature_columns` as rows; NULL becomes NaN."""
    out = np.empty((len(columns[0]), len(columns)))
    for i, column in enumerate(columns):
        out[:, i] = column.to_numpy(zero_copy_only=False)
    return out


def top_entries(values: np.ndarray, keep: np.ndarray, features: list[str], k: int) -> pa.ListArray:
    """The k largest kept values of each row as ``TOP_SCHEMA``; ties: the later column first, NaN is largest."""
    # the first maximum of the turned rows is the later column
    left = np.where(keep, values, -np.inf)[:, ::-1]
    rows, width = np.arange(len(left)), left.shape[1]
    picked, taken = [], []
    for _ in range(min(k, width)):
        at = left.argmax(axis=1)
        value = left[rows, at]
        picked.append((value, width - 1 - at))
        taken.append(value != -np.inf)
        left[rows, at] = -np.inf
    taken = np.stack(taken, axis=1)
    value, position = (np.stack(c, axis=1)[taken] for c in zip(*picked))
    place = pa.array(position.astype(np.int32))
    entries = pa.StructArray.from_arrays(
        [pa.array(value), place, pa.array(features, pa.string()).take(place)], ["value", "position", "feature"]
    )
    offsets = np.concatenate([[0], taken.sum(axis=1).cumsum()]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


def average_path(n: np.ndarray) -> np.ndarray:
    """Expected path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    many = n > 2
    m = n[many]
    out[many] = 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one isolation tree: random feature, random threshold, until alone or too deep."""
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        me = len(nodes)
        nodes.append([me, -1, 0.0, me, me, len(rows), depth])
        if parent >= 0:
            nodes[parent][3 + side] = me
        if depth >= limit or len(rows) <= 1:
            continue
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if not len(splittable):
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= threshold
        if goes_left.all():  # the draw hit the upper end
            continue
        nodes[me][1], nodes[me][2] = feature, threshold
        todo.append((rows[~goes_left], depth + 1, me, 1))
        todo.append((rows[goes_left], depth + 1, me, 0))
    return [tuple(n) for n in nodes]


@dataclass
class IsolationForest:
    n_estimators: int = 200
    max_samples: int = 256
    contamination: float | str = "auto"
    seed: int = 42
    row_id: str = "transaction_id"
    features: list[str] = field(default_factory=list)
    scaler: pd.DataFrame | None = None
    nodes: pd.DataFrame | None = None
    sample_size: int = 0
    bounds: tuple[float, float] | None = None

    # --- fitting ---

    def _samples(self, df: DataFrame, n: int) -> DataFrame:
        """(tree, draw, row) with somewhat more than ``sample_size`` rows per tree.

        Every tree takes every row with the same probability, whatever the table's size. A row does
        not try all trees: the trees that take it are reached by geometric steps from its hashes, so
        most rows of a large table cost one hash, and a lost task draws the same rows again.
        """
        trees, want = self.n_estimators, 1.5 * self.sample_size + 50
        rate = min(want / n, 1.0)
        named = df.select(F.col(self.row_id).alias("_id"), *self.features)

        def draw(tree: Column) -> Column:
            hashed = F.xxhash64("_id", tree, F.lit(self.seed + 1))
            return F.pmod(hashed, F.lit(1 << 40)) / F.lit(float(1 << 40))

        if rate >= 1.0:
            taken = F.sequence(F.lit(0), F.lit(trees - 1))
        else:

            def skipped(k: Column) -> Column:
                """Trees passed over before the k-th that takes the row."""
                hashed = F.pmod(F.xxhash64("_id", k, F.lit(self.seed)), F.lit(1 << 40))
                chance = (hashed + F.lit(1)) / F.lit(float((1 << 40) + 1))
                return F.least(F.floor(F.log(chance) / F.lit(math.log1p(-rate))), F.lit(trees)).cast("int")

            none = F.struct(F.lit(-1).alias("at"), F.array().cast("array<int>").alias("taken"))

            def step(so_far: Column, k: Column) -> Column:
                at = so_far["at"] + 1 + skipped(k)
                return F.when(so_far["at"] >= trees, so_far).otherwise(
                    F.struct(
                        at.alias("at"),
                        F.when(at < trees, F.array_append(so_far["taken"], at))
                        .otherwise(so_far["taken"])
                        .alias("taken"),
                    )
                )

            named = named.where(skipped(F.lit(0)) < trees)
            taken = F.aggregate(F.sequence(F.lit(0), F.lit(trees - 1)), none, step)["taken"]
        placed = named.withColumn("tree", F.explode(taken))
        return placed.withColumn("_draw", draw(F.col("tree")))

    def fit(
        self, df: DataFrame, features: list[str], stats: pd.DataFrame | None = None
    ) -> IsolationForest:
        """``stats`` is an earlier :func:`standardiser` result with floor 0."""
        self.features = list(features)
        self.scaler = with_floor(standardiser(df, self.features, 0.0) if stats is None else stats)
        # twelve digits: the order in which partial sums meet must not show in the trees
        for column in ("mean", "std"):
            self.scaler[column] = [float(f"{x:.12g}") for x in self.scaler[column]]
        n = self.scaler.attrs["n"]
        if n == 0:
            raise ValueError("cannot fit on an empty table")
        self.sample_size = min(self.max_samples, n)
        names, seed, size = self.features, self.seed, self.sample_size
        mean, std = self.scaler["mean"].to_numpy(), self.scaler["std"].to_numpy()
        limit = max(1, math.ceil(math.log2(max(size, 2))))

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            drawn = pdf.sort_values(["_draw", "_id"]).head(size)
            x = (drawn[names].to_numpy(dtype=float) - mean) / std
            rows = _grow(x, np.random.default_rng([seed, tree]), limit)
            out = pd.DataFrame(
                rows, columns=["node", "feature", "threshold", "left", "right", "size", "depth"]
            )
            out.insert(0, "tree", tree)
            return out

        grown = self._samples(df, n).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
        # bounded: n_estimators * (2 * max_samples - 1) rows
        self.nodes = grown.toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
        return self

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    @property
    def importances(self) -> np.ndarray:
        """Share of splits per feature."""
        used = self.nodes.loc[self.nodes["feature"] >= 0, "feature"]
        counts = np.bincount(used, minlength=len(self.features)).astype(float)
        return counts / counts.sum() if counts.sum() else counts

    # --- scoring ---

    def _packed(self) -> dict[str, np.ndarray]:
        """Nodes of all trees in flat arrays; both children of a leaf are the leaf itself."""
        n = self.nodes
        first = n.groupby("tree").size().cumsum().shift(fill_value=0)
        base = n["tree"].map(first).to_numpy()
        children = np.stack([n["left"].to_numpy() + base, n["right"].to_numpy() + base], axis=1)
        return {
            "root": first.to_numpy().astype(np.intp),
            "feature": np.maximum(n["feature"].to_numpy(), 0).astype(np.intp),
            "threshold": n["threshold"].to_numpy(),
            "child": children.astype(np.intp).ravel(),
            "path": n["depth"].to_numpy() + average_path(n["size"].to_numpy()),
        }

    def raw_column(self, spark: SparkSession) -> Column:
        """The anomaly value 2^(-path / c(sample)); only the feature columns go to Python."""
        shared = spark.sparkContext.broadcast(self._packed())
        mean, std = self.scaler["mean"].to_numpy(), self.scaler["std"].to_numpy()
        depth = int(self.nodes["depth"].max()) if len(self.nodes) else 0
        norm = float(average_path(np.array([self.sample_size]))[0]) or 1.0

        @F.arrow_udf("double")
        def score(*columns: pa.Array) -> pa.Array:
            f = shared.value
            feature, threshold, child = f["feature"], f["threshold"], f["child"]
            x = (feature_rows(columns) - mean) / std
            out = np.empty(len(x))
            for start in range(0, len(x), _CHUNK):
                part = x[start : start + _CHUNK]
                row = (np.arange(len(part)) * part.shape[1])[:, None]
                values = part.ravel()
                at = np.repeat(f["root"][None, :], len(part), axis=0)
                other, value, limit = np.empty_like(at), np.empty(at.shape), np.empty(at.shape)
                for _ in range(depth):
                    # all indices are within bounds; "clip" writes to ``out`` without a copy
                    feature.take(at, out=other, mode="clip")
                    other += row
                    values.take(other, out=value, mode="clip")
                    threshold.take(at, out=limit, mode="clip")
                    at += at
                    at += value > limit
                    child.take(at, out=other, mode="clip")
                    at, other = other, at
                out[start : start + _CHUNK] = np.exp2(-f["path"].take(at).mean(axis=1) / norm)
            return pa.array(out, from_pandas=True)

        return score(*feature_columns(self.features))

    def raw_score(self, df: DataFrame, name: str = "_forest_raw") -> DataFrame:
        """Add the anomaly value of :meth:`raw_column`."""
        return df.withColumn(name, self.raw_column(df.sparkSession))

    def calibrate(self, df: DataFrame) -> tuple[float, float]:
        """Remember the range of raw scores of ``df`` for scoring with ``calibration='fit'``."""
        row = self.raw_score(df).agg(F.min("_forest_raw"), F.max("_forest_raw")).first()
        self.bounds = (float(row[0]), float(row[1]))
        return self.bounds

    def score(
        self, df: DataFrame, *, calibration: str = "batch", name: str = "isolation_forest_score"
    ) -> DataFrame:
        """Add the score scaled to [0, 1] by the batch's own range, or by the remembered one.

        The batch range needs all raw scores before the first result: hand in a written table with
        ``_forest_raw`` (from :meth:`raw_score`) to evaluate the trees once. The remembered range
        needs one pass.
        """
        raw = df if "_forest_raw" in df.columns else self.raw_score(df)
        value = F.col("_forest_raw")
        if calibration == "fit":
            if self.bounds is None:
                raise ValueError("call calibrate() first")
            low, high = F.lit(self.bounds[0]), F.lit(self.bounds[1])
        else:
            span = raw.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
            low, high = span["low"], span["high"]
        scaled = (value - low) / (high - low + F.lit(_EPSILON))
        if calibration == "fit":
            scaled = F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))
        return raw.withColumn(name, scaled).drop("_forest_raw")

    def contributions(self, k: int = 5) -> Column:
        """The k features with the largest |z| * importance, as (value, position, feature)."""
        weights = self.importances
        pairs = [
            (name, F.abs(z) * F.lit(float(w)))
            for (name, z), w in zip(standardised(self.scaler), weights)
        ]
        return top_per_row(pairs, k)

    def top_contributions(self, k: int, above: float) -> Column:
        """:meth:`contributions` greater than ``above``, found in Arrow batches."""
        mean, std = self.scaler["mean"].to_numpy(), self.scaler["std"].to_numpy()
        weights, features = self.importances, self.features

        @F.arrow_udf(TOP_SCHEMA)
        def top(*columns: pa.Array) -> pa.Array:
            values = np.abs((feature_rows(columns) - mean) / std) * weights
            known = [c.is_valid().to_numpy(zero_copy_only=False) for c in columns]
            return top_entries(values, ~(values <= above) & np.stack(known, axis=1), features, k)

        return top(*feature_columns(features))

    # --- storage ---

    def save(self, spark: SparkSession, path: str) -> None:
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        scaler = self.scaler.assign(position=range(len(self.features)))
        spark.createDataFrame(scaler).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
        low, high = self.bounds or (None, None)
        facts = [(self.n_estimators, self.max_samples, str(self.contamination), self.seed, self.sample_size, low, high)]
        schema = (
            "n_estimators int, max_samples int, contamination string, seed int, sample_size int, "
            "low double, high double"
        )
        spark.createDataFrame(facts, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        facts = spark.read.parquet(f"{path}/facts").first()
        scaler = spark.read.parquet(f"{path}/scaler").toPandas().sort_values("position")
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        return cls(
            n_estimators=facts["n_estimators"],
            max_samples=facts["max_samples"],
            contamination=facts["contamination"],
            seed=facts["seed"],
            features=scaler["feature"].tolist(),
            scaler=scaler[["feature", "mean", "std"]].reset_index(drop=True),
            nodes=nodes.sort_values(["tree", "node"]).reset_index(drop=True),
            sample_size=facts["sample_size"],
            bounds=None if facts["low"] is None else (facts["low"], facts["high"]),
        )


def predicted(score: str, threshold: float = 0.5) -> Column:
    """1 where the score reaches the threshold."""
    return F.when(F.col(score) >= threshold, 1).otherwise(0)


def split_shares(nodes: DataFrame) -> DataFrame:
    """Splits per feature and their share, from a node table."""
    splits = nodes.where(F.col("feature") >= 0)
    counted = splits.groupBy("feature").agg(F.count("*").alias("splits"))
    total = splits.agg(F.count("*")).scalar()
    return counted.select("feature", "splits", (F.col("splits") / total).alias("importance"))
