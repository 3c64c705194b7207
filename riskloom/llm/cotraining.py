"""Quality classifier by co-training of two views: what a text says, and what surrounds it.

The content view sees hashed words and letter shapes of the whole text; the metadata view sees
source, language, size, and line layout. Each view is a logistic model. In every round both views
label the pool's texts they are surest of, and each learns from the other's labels. At the end both
are calibrated on labelled rows kept aside and their log-odds are added by fitted weights. Training
uses bounded samples of labelled and unlabelled rows; all documents are scored, whole, in tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import bounded_sample, remainder, table

#: Bounds of the samples: labelled rows of each label, and unlabelled rows.
ROWS_PER_LABEL = 1500
POOL = 3000
ROUNDS = 5
#: Pool rows of each label a view passes on in a round.
EXCHANGED = 150
SURE = 0.9

WORD_BUCKETS = 1024
META_BUCKETS = 256
_SHAPES = (
    re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"), re.compile(r"[^\x00-\x7f]"),
    re.compile(r"[.,;:?]"), re.compile("!"), re.compile(r"\|"), re.compile(r"[#*$%&<>]"),
)
_NO_MARKS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
_DROP = [bytes(b for b in range(256) if not p.fullmatch(chr(b) if b < 128 else "é")) for p in _SHAPES]
CONTENT = WORD_BUCKETS + 2 * len(_SHAPES) + 4
META = META_BUCKETS + 8


def content_features(text: str | None) -> np.ndarray:
    """Shares of hashed words (square roots, unit length) and of character shapes, and repetition."""
    out = np.zeros(CONTENT, np.float32)
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else b""
    words = raw.translate(_NO_MARKS).split()
    if words:
        codes = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % WORD_BUCKETS
        counts = np.bincount(codes, minlength=WORD_BUCKETS)
        out[:WORD_BUCKETS] = np.sqrt(counts / len(words))
        at = WORD_BUCKETS + 2 * len(_SHAPES)
        out[at] = len(set(words)) / len(words)
        out[at + 1] = min(1.0, len(words) / 100.0)
        out[at + 2] = min(2.0, len(raw) / len(words) / 10.0)
    if raw:
        share = np.array([len(raw.translate(None, drop)) / len(raw) for drop in _DROP])
        out[WORD_BUCKETS : WORD_BUCKETS + len(share)] = share
        out[WORD_BUCKETS + len(share) : WORD_BUCKETS + 2 * len(share)] = np.sqrt(share)
    out[-1] = 1.0
    return out


def metadata_features(source, lang, n_chars, text: str | None) -> np.ndarray:
    """Hashed source and language, the recorded size, and the layout of lines (not their words)."""
    out = np.zeros(META, np.float32)
    for kind, value in (("source", source), ("lang", lang)):
        out[zlib.crc32(f"{kind}={value}".encode()) % META_BUCKETS] += 1.0
    size = 0.0 if n_chars is None or n_chars != n_chars else max(0.0, float(n_chars))
    text = text if isinstance(text, str) else ""
    lines = text.count("\n") + 1
    at = META_BUCKETS
    out[at] = np.log1p(size) / 10.0
    out[at + 1] = np.log1p(lines) / 5.0
    out[at + 2] = np.log1p(len(text) / lines) / 5.0
    out[at + 3] = min(1.0, text.count("\n\n") / lines)
    out[at + 4] = float(size < 100)
    out[at + 5] = min(2.0, text.count(" ") / max(1.0, len(text)) * 5.0)
    out[at + 6] = float(bool(text) and text[-1] in ".!?")
    out[-1] = 1.0
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 150):
    """Weights of a logistic model: accelerated gradient descent on all rows."""
    weight = weight / max(weight.sum(), 1e-9)
    rate = 1.0 / (0.25 * float((x * x).sum(1).max(initial=1.0)) + penalty)
    w = ahead = np.zeros(x.shape[1], np.float64)
    t = 1.0
    for _ in range(steps):
        grad = x.T @ ((_sigmoid(x @ ahead) - y) * weight) + penalty * ahead
        new = ahead - rate * grad
        t_next = (1.0 + np.sqrt(1.0 + 4.0 * t * t)) / 2.0
        ahead, w, t = new + (t - 1.0) / t_next * (new - w), new, t_next
    return w


def _balanced(y: np.ndarray) -> np.ndarray:
    share = max(1e-9, y.mean()) if len(y) else 0.5
    return np.where(y > 0, 0.5 / share, 0.5 / max(1e-9, 1.0 - share))


@dataclass
class QualityModel:
    content: np.ndarray
    metadata: np.ndarray
    content_scale: np.ndarray  # slope and offset of the calibrated log-odds
    metadata_scale: np.ndarray
    combine: np.ndarray  # weights of both log-odds, and an offset
    exchanged: list[int] = field(default_factory=list)

    def views(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = self.content_scale[0] * (content @ self.content) + self.content_scale[1]
        b = self.metadata_scale[0] * (metadata @ self.metadata) + self.metadata_scale[1]
        return a, b


def cotrain(
    content: np.ndarray, metadata: np.ndarray, y: np.ndarray, kept_aside: np.ndarray,
    pool_content: np.ndarray, pool_metadata: np.ndarray, rounds: int = ROUNDS,
) -> QualityModel:
    learn = ~kept_aside
    views = [
        (content[learn], pool_content, {}),
        (metadata[learn], pool_metadata, {}),
    ]
    exchanged: list[int] = []

    def fitted(own, pool, given):
        rows = np.array(sorted(given), int)
        x = np.vstack([own, pool[rows]]) if len(rows) else own
        labels = np.r_[y[learn], [given[k] for k in rows.tolist()]]
        # a passed-on label counts half of a true one
        return logistic(x, labels, _balanced(labels) * np.r_[np.ones(learn.sum()), np.full(len(rows), 0.5)])

    for _ in range(rounds):
        models = [fitted(*v) for v in views]
        passed = 0
        for (_, pool, _), w, (_, _, other) in zip(views, models, views[::-1]):
            if not len(pool):
                continue
            p = _sigmoid(pool @ w)
            for label, order in ((1.0, np.argsort(-p, kind="stable")), (0.0, np.argsort(p, kind="stable"))):
                sure = [k for k in order.tolist() if k not in other][:EXCHANGED]
                sure = [k for k in sure if (p[k] if label else 1.0 - p[k]) >= SURE]
                other.update(dict.fromkeys(sure, label))
                passed += len(sure)
        exchanged.append(passed)
        if not passed:
            break
    a, b = [fitted(*v) for v in views]
    za, zb = content[kept_aside] @ a, metadata[kept_aside] @ b
    ya = y[kept_aside]
    if len(set(ya.tolist())) < 2:
        unit = np.array([1.0, 0.0])
        return QualityModel(a, b, unit, unit, np.array([1.0, 1.0, 0.0]), exchanged)
    one = np.ones(len(ya))
    scale_a = logistic(np.c_[za, one], ya, _balanced(ya), 1e-4, 500)
    scale_b = logistic(np.c_[zb, one], ya, _balanced(ya), 1e-4, 500)
    both = np.c_[np.c_[za, one] @ scale_a, np.c_[zb, one] @ scale_b, one]
    return QualityModel(a, b, scale_a, scale_b, logistic(both, ya, _balanced(ya), 1e-3, 500), exchanged)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, width), np.float64)
    return np.stack([np.frombuffer(b, "<f4") for b in column]).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> QualityModel | None:
    """Co-train on bounded samples; None unless rows of both labels exist.

    Of rows labelled twice the larger label counts. A fifth of the labelled rows, by id hash, is kept
    for calibration.
    """

    @pandas_udf("struct<c:binary,m:binary>")
    def both(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        for text, source, lang, n_chars in batches:
            rows = list(zip(text, source, lang, n_chars))
            yield pd.DataFrame(
                {
                    "c": [content_features(t).astype("<f4").tobytes() for t, *_ in rows],
                    "m": [metadata_features(s, x, n, t).astype("<f4").tobytes() for t, s, x, n in rows],
                }
            )

    marked = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    asked = F.broadcast(  # bounded by ROWS_PER_LABEL
        bounded_sample(marked, "quality", [F.col("doc_id"), F.lit("quality")], ROWS_PER_LABEL, "doc_id", "quality")
    )
    columns = ["doc_id", "text", "source", "lang", "n_chars"]
    known = docs.select(*columns).join(asked, "doc_id")
    known = known.withColumn("x", both("text", "source", "lang", "n_chars"))
    known = known.select("doc_id", "quality", (remainder(F.col("doc_id"), 5) == 1).alias("aside"), "x.c", "x.m")
    known = known.toPandas().sort_values("doc_id", kind="stable")
    y = (known.quality.to_numpy() > 0).astype(float)
    aside = known.aside.to_numpy(bool)
    if len(set(y[~aside].tolist())) < 2:
        return None
    # the pool: any rows without a label, as many as its bound, by hash
    ids = docs.select("doc_id", F.lit("pool").alias("stratum")).join(marked, "doc_id", "left_anti")
    pool_ids = F.broadcast(
        bounded_sample(ids, "stratum", [F.col("doc_id"), F.lit("pool")], POOL, "doc_id").distinct()
    )
    pool = docs.select(*columns).join(pool_ids, "doc_id").withColumn("x", both("text", "source", "lang", "n_chars"))
    pool = pool.select("doc_id", "x.c", "x.m").toPandas().sort_values("doc_id", kind="stable")
    return cotrain(
        _matrix(known.c, CONTENT), _matrix(known.m, META), y, aside,
        _matrix(pool.c, CONTENT), _matrix(pool.m, META), rounds,
    )


def _scored(docs: DataFrame, model: QualityModel, name: str) -> DataFrame:
    @pandas_udf("struct<content:double,metadata:double,score:double>")
    def score(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        for text, source, lang, n_chars in batches:
            rows = list(zip(text, source, lang, n_chars))
            out = np.zeros((len(rows), 3))
            for at in range(0, len(rows), 1024):
                some = rows[at : at + 1024]
                content = np.stack([content_features(t) for t, *_ in some])
                metadata = np.stack([metadata_features(s, x, n, t) for t, s, x, n in some])
                a, b = model.views(content, metadata)
                z = model.combine[0] * a + model.combine[1] * b + model.combine[2]
                out[at : at + 1024] = np.c_[_sigmoid(a), _sigmoid(b), _sigmoid(z)]
            yield pd.DataFrame(out, columns=["content", "metadata", "score"])

    return docs.withColumn(name, score("text", "source", "lang", "n_chars"))


def score_documents(docs: DataFrame, labels: DataFrame, model: QualityModel | None = None) -> DataFrame:
    """One row per document: ``doc_id, content_score, metadata_score, score, kept``.

    ``kept`` is ``score >= 0.5``. Null and empty texts, null sources, languages and sizes are values
    like any other. Repeated rows are kept. Without labelled rows of both kinds every score is 0.5
    and every row kept. Only ``doc_id, text, source, lang, n_chars`` are read.
    """
    docs = docs.select("doc_id", "text", "source", "lang", "n_chars")
    model = model or fit(docs, labels)
    if model is None:
        half = F.lit(0.5)
        return docs.select(
            "doc_id", half.alias("content_score"), half.alias("metadata_score"),
            half.alias("score"), F.lit(True).alias("kept"),
        )
    found = _scored(docs, model, "q")
    return found.select(
        "doc_id", F.col("q.content").alias("content_score"), F.col("q.metadata").alias("metadata_score"),
        F.col("q.score").alias("score"), (F.col("q.score") >= 0.5).alias("kept"),
    )


def op9_quality_cotraining(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
