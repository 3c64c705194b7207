"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of three hashed embeddings: the word, its first five and first four
bytes. Filters of several widths run over all words, their largest responses in the text feed a
logistic unit. Training reads every labelled row it may learn from, in shards of bounded size: in each
round tasks train on their shards, all from the same weights, and what the shards changed is averaged.
Gradients reach only the windows that won the pooling. A threshold per text language, from counts over
all rows kept out of training, moves the logit so that 0.5 decides. The language is read off the text's
commonest words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import (
    fresh,
    give_back_memory,
    remainder,
    stored,
    table,
)

BUCKETS = 1 << 15
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 12
#: Most rows and bytes of packed words (six a word) a shard of the training rows is meant to hold.
SHARD_ROWS, SHARD_BYTES = 4096, 64 << 20
#: Labelled rows that are sent to the texts; of more, the texts are shuffled to their labels.
BROADCAST_ROWS = 4_000_000
#: Rows of the embedding table that are averaged together, and steps of a logit thresholds are found on.
_BLOCK, _STEPS = 2048, 1024
#: Embedding rows seen in fewer training texts stay zero: they could only be learned by heart.
MIN_TEXTS = 3
#: A longer text is folded piece by piece, so memory follows the piece and not the text.
_PIECE = 1 << 15

# Very common words of four languages, used to choose a threshold.
COMMON = {
    "en": "the of and to in is that for was with as are this have be by",
    "fr": "le la les et des du un une est dans que qui pour pas sur avec",
    "de": "der die und das den von ist nicht mit ein eine im zu auf sich für",
    "es": "el los las y que en una por con para del se al es lo no",
}
_LANGUAGES = [*COMMON, "other"]
_WORD_LANGUAGE: dict[bytes, int] = {}
for _k, _words in enumerate(COMMON.values()):
    for _word in _words.split():
        _WORD_LANGUAGE.setdefault(_word.encode(), _k)

#: A-Z lowered, other ASCII that is no letter or digit becomes a blank.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def split_words(text: str | None) -> list[bytes]:
    if not isinstance(text, str):
        return []
    return text.encode("utf-8", "replace").translate(_TABLE).split()


def word_buckets(word: bytes) -> tuple[int, int, int]:
    """Rows of the embedding table: the word, its first five bytes, its first four bytes."""
    mask = BUCKETS - 1
    return (
        zlib.crc32(word) & mask,
        zlib.crc32(word[:5], 0x5EED) & mask,
        zlib.crc32(word[:4], 0xF00D) & mask,
    )


class Vocabulary:
    """Dense numbers for the words seen in a batch, with their buckets and languages."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.buckets: list[tuple[int, int, int]] = []
        self.language: list[int] = []

    def ids(self, words: list[bytes]) -> np.ndarray:
        number = self.number
        for w in set(words).difference(number):
            number[w] = len(number)
            self.buckets.append(word_buckets(w))
            self.language.append(_WORD_LANGUAGE.get(w, len(COMMON)))
        return np.fromiter(map(number.__getitem__, words), np.int32, len(words))


@dataclass
class ToxicityModel:
    embedding: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # one per width: width x DIM x FILTERS
    bias: np.ndarray  # widths * FILTERS
    output: np.ndarray
    offset: float
    thresholds: np.ndarray  # logits, by language

    def tables(self) -> np.ndarray:
        """Response of each embedding row at each place of each filter: BUCKETS x places x FILTERS."""
        return np.concatenate([self.embedding @ w for f in self.filters for w in f], axis=1)


def _responses(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Filter responses of windows that start at each word; ``rows`` holds the places side by side.

    The words of a batch stand one after the other with two empty words behind each text.
    """
    out, k = [], 0
    n = len(at)
    for width in WIDTHS:
        total = rows[at[:n], k * FILTERS : (k + 1) * FILTERS].copy()
        for j in range(1, width):
            part = rows[:, (k + j) * FILTERS : (k + j + 1) * FILTERS]
            total[: n - j] += part[at[j:]]
        out.append(total)
        k += width
    return np.concatenate(out, axis=1)


def _pooled(model: ToxicityModel, tables: np.ndarray, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(pooled responses, index of the language) of each text, read whole."""
    vocabulary = Vocabulary()
    pooled = np.zeros((len(texts), len(model.bias)), np.float32)
    tongue = np.full(len(texts), len(COMMON))
    pending, owners = [], []

    def flush():
        if not pending:
            return
        empty = len(vocabulary.number)
        gap = np.full(2, empty, np.int32)
        buckets = np.array(vocabulary.buckets, np.int32).reshape(-1, 3)
        rows = tables[buckets[:, 0]] + tables[buckets[:, 1]] + tables[buckets[:, 2]]
        rows = np.vstack([rows, np.zeros((1, rows.shape[1]), np.float32)])
        at = np.concatenate([x for ids in pending for x in (ids, gap)])
        size = np.array([len(ids) + 2 for ids in pending])
        begin = np.cumsum(size) - size
        found = _responses(rows, at)
        found[at == empty] = 0.0  # a window that begins behind a text must not see the next one
        best = np.maximum.reduceat(found, begin, axis=0)
        np.maximum.at(pooled, np.array(owners), np.maximum(best + model.bias, 0.0))
        code = np.array([*vocabulary.language, len(COMMON)], np.int8)[at]
        for k in range(len(COMMON)):
            np.add.at(seen[:, k], np.array(owners), np.add.reduceat(code == k, begin, dtype=np.int64))
        pending.clear()
        owners.clear()

    seen = np.zeros((len(texts), len(COMMON)), np.int64)
    load = 0
    for k, text in enumerate(texts):
        words = split_words(text)
        # pieces overlap by the widest filter less one, so no window is lost
        for at in range(0, max(1, len(words)), _PIECE):
            ids = vocabulary.ids(words[at : at + _PIECE + max(WIDTHS) - 1])
            pending.append(ids)
            owners.append(k)
            load += len(ids)
            if load >= _PIECE:
                flush()
                load = 0
                vocabulary = Vocabulary()
    flush()
    found = seen.max(1) > 0
    tongue[found] = seen[found].argmax(1)
    return pooled, tongue


def _logits(model: ToxicityModel, tables: np.ndarray, texts: list) -> tuple[np.ndarray, np.ndarray]:
    pooled, tongue = _pooled(model, tables, texts)
    return pooled @ model.output + model.offset, tongue


def _start(common: np.ndarray, seed: int) -> tuple[ToxicityModel, dict]:
    """A model before training, and the sums of squared gradients that Adagrad keeps."""
    rng = np.random.default_rng(seed)
    m = ToxicityModel(
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
        [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, np.float32),
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
        0.0,
        np.zeros(len(_LANGUAGES)),
    )
    m.embedding[~common] = 0.0
    past = {
        "e": np.full((BUCKETS, 1), 1e-2, np.float32),
        "f": [np.full_like(f, 1e-2) for f in m.filters],
        "b": np.full_like(m.bias, 1e-2),
        "o": np.full_like(m.output, 1e-2),
        "c": 1e-2,
    }
    return m, past


def _weights(m: ToxicityModel, past: dict) -> tuple[np.ndarray, np.ndarray]:
    """All that training changes: by embedding row, and the rest in one line."""
    rest = [*m.filters, m.bias, m.output, m.offset, *past["f"], past["b"], past["o"], past["c"]]
    return np.hstack([m.embedding, past["e"]]), np.concatenate([np.ravel(x).astype(float) for x in rest])


def _from_weights(rows: np.ndarray, rest: np.ndarray) -> tuple[ToxicityModel, dict]:
    """The inverse of :func:`_weights`, on copies."""
    shapes = [*[(w, DIM, FILTERS) for w in WIDTHS], *[(len(WIDTHS) * FILTERS,)] * 2, ()] * 2
    parts, at = [], 0
    for shape in shapes:
        size = math.prod(shape)
        parts.append(rest[at : at + size].reshape(shape).astype(np.float32))
        at += size
    n = len(WIDTHS)
    m = ToxicityModel(
        rows[:, :DIM].copy(), parts[:n], parts[n], parts[n + 1], float(parts[n + 2]), np.zeros(len(_LANGUAGES))
    )
    f, (b, o, c) = parts[n + 3 : 2 * n + 3], parts[2 * n + 3 :]
    return m, {"e": rows[:, DIM:].copy(), "f": f, "b": b, "o": o, "c": float(c)}


def _train(
    m: ToxicityModel,
    past: dict,
    texts: list[np.ndarray],
    labels: np.ndarray,
    common: np.ndarray,
    epochs: int,
    rng: np.random.Generator,
) -> None:
    """Adagrad over small batches, in place; ``texts`` hold three buckets for each word."""
    rate, batch = 0.1, 16
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), batch):
            some = order[low : low + batch]
            grad_e_rows, grad_e = [], []
            grad_f = [np.zeros_like(f) for f in m.filters]
            pooled = np.zeros((len(some), len(m.bias)), np.float32)
            won = np.zeros((len(some), len(m.bias)), np.int64)
            vectors = []
            for k, i in enumerate(some):
                x = m.embedding[texts[i]].sum(1) if len(texts[i]) else np.zeros((0, DIM), np.float32)
                x = np.vstack([x, np.zeros((2, DIM), np.float32)])
                vectors.append(x)
                for q, (width, f) in enumerate(zip(WIDTHS, m.filters)):
                    z = x @ f[0]
                    for j in range(1, width):
                        z[: len(x) - j] += x[j:] @ f[j]
                    top = z.argmax(0)
                    own = slice(q * FILTERS, (q + 1) * FILTERS)
                    won[k, own], pooled[k, own] = top, z[top, np.arange(FILTERS)]
            live = np.maximum(pooled + m.bias, 0.0)
            p = 1.0 / (1.0 + np.exp(-np.clip(live @ m.output + m.offset, -30, 30)))
            error = ((p - labels[some]) / len(some)).astype(np.float32)
            back = error[:, None] * m.output * (live > 0)
            for k, i in enumerate(some):
                x, ids = vectors[k], texts[i]
                for q, (width, f) in enumerate(zip(WIDTHS, m.filters)):
                    g = back[k, q * FILTERS : (q + 1) * FILTERS]
                    top = won[k, q * FILTERS : (q + 1) * FILTERS]
                    for j in range(width):
                        at = top + j
                        inside = (at < len(x)) & (g != 0)
                        grad_f[q][j][:, inside] += x[at[inside]].T * g[inside]
                        word = inside & (at < len(ids))
                        if word.any():
                            step = (f[j][:, word] * g[word]).T
                            grad_e_rows.append(ids[at[word]].ravel())
                            grad_e.append(np.repeat(step, 3, axis=0))
            if grad_e:
                rows, inverse = np.unique(np.concatenate(grad_e_rows), return_inverse=True)
                total = np.zeros((len(rows), DIM), np.float32)
                np.add.at(total, inverse, np.concatenate(grad_e))
                total[~common[rows]] = 0.0
                past["e"][rows] += (total**2).mean(1, keepdims=True)
                m.embedding[rows] -= rate * total / np.sqrt(past["e"][rows])
            for q, g in enumerate(grad_f):
                past["f"][q] += g**2
                m.filters[q] -= rate * g / np.sqrt(past["f"][q])
            g = back.sum(0)
            past["b"] += g**2
            m.bias -= rate * g / np.sqrt(past["b"])
            g = live.T @ error
            past["o"] += g**2
            m.output -= rate * g / np.sqrt(past["o"])
            past["c"] += float(error.sum()) ** 2
            m.offset -= rate * float(error.sum()) / past["c"] ** 0.5


def _threshold(logit: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The cut with the most right decisions; of equal ones the middle of the widest gap.

    ``toxic`` and ``clean`` count the rows at each logit.
    """
    order = np.argsort(logit)
    logit, toxic, clean = logit[order], toxic[order], clean[order]
    wrong = np.r_[0, np.cumsum(toxic)] + np.r_[np.cumsum(clean[::-1])[::-1], 0]
    edge = np.r_[logit[0] - 2.0, logit, logit[-1] + 2.0]
    gap = np.where(wrong == wrong.min(), np.diff(edge), -1.0)
    k = int(gap.argmax())
    return float((edge[k] + edge[k + 1]) / 2.0)


SHARD_SCHEMA = "shard long, x array<binary>, toxic array<int>"


def _packed(text: str | None) -> tuple[bytes, int]:
    """Three buckets a word of a text, compressed, and the bytes they take without that.

    A shard is one row, and what moves it holds several copies outside the heap: a shard is compressed
    until a task trains on it.
    """
    memo = {}
    rows = [memo.get(w) or memo.setdefault(w, word_buckets(w)) for w in split_words(text)]
    x = np.array(rows, "<u2").tobytes()
    return zlib.compress(x, 1), len(x)


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), "<u2").reshape(-1, 3)


def _sharded(rows: DataFrame, n: int) -> DataFrame:
    """The training rows in ``n`` shards, one row each."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "x"], kind="stable")
        line = (int(pdf.shard.iloc[0]), pdf.x.tolist(), pdf.toxic.astype(int).tolist())
        return pd.DataFrame([line], columns=["shard", "x", "toxic"])

    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(n))
    return stored(
        rows.select(shard.alias("shard"), "doc_id", "toxic", "x").groupBy("shard").applyInPandas(pack, SHARD_SCHEMA)
    )


def _common(shards: DataFrame) -> np.ndarray:
    """Embedding rows that enough training texts use."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(BUCKETS, np.int64)
        for pdf in batches:
            for x in pdf.x:
                for text in x:
                    seen[np.unique(_unpacked(text))] += 1
        used = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": used, "n": seen[used]})
        give_back_memory()

    counts = shards.select("x").mapInPandas(count, "bucket long, n long")
    found = counts.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TEXTS)
    common = np.zeros(BUCKETS, bool)
    common[found.toPandas().bucket.to_numpy(dtype=int)] = True  # at most BUCKETS rows
    return common


def _round(
    shards: DataFrame, rows: np.ndarray, rest: np.ndarray, common: np.ndarray, epochs: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights after every shard trained on its own from the given ones.

    An embedding row moves by the mean over the shards that moved it, all else by the mean over all. Each
    task returns sums over its shards, and the sums are added by block, so the driver gets one model.
    """
    blocks = BUCKETS // _BLOCK

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        moved = np.zeros((BUCKETS, DIM + 2))
        total = np.zeros(len(rest) + 1)
        for pdf in batches:
            for shard, x, toxic in zip(pdf["shard"], pdf["x"], pdf["toxic"]):
                m, past = _from_weights(rows, rest)
                y = (np.asarray(toxic) > 0).astype(np.float32)
                _train(m, past, [_unpacked(text) for text in x], y, common, epochs, np.random.default_rng([seed, shard]))
                now, now_rest = _weights(m, past)
                change = now - rows
                moved[:, :-1] += change
                moved[:, -1] += (change != 0).any(axis=1)
                total += np.r_[now_rest - rest, 1.0]
        if total[-1]:
            parts = [*np.split(moved.ravel(), blocks), total]
            sums = [p.astype(np.float32).tobytes() for p in parts]
            yield pd.DataFrame({"block": range(blocks + 1), "sums": sums})
        give_back_memory()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = np.sum([np.frombuffer(b, np.float32) for b in pdf.sums], axis=0, dtype=float)
        return pd.DataFrame({"block": [pdf.block.iloc[0]], "sums": [sums.astype(np.float32).tobytes()]})

    schema = "block int, sums binary"
    found = shards.mapInPandas(step, schema).groupBy("block").applyInPandas(add, schema)
    sums = [np.frombuffer(b, np.float32).astype(float) for b in found.toPandas().sort_values("block").sums]
    moved = np.concatenate(sums[:-1]).reshape(BUCKETS, DIM + 2)
    rows = rows + (moved[:, :-1] / np.maximum(moved[:, -1:], 1.0)).astype(np.float32)
    return rows, rest + sums[-1][:-1] / sums[-1][-1]


def fit(
    docs: DataFrame, labels: DataFrame, visits: int = 25_000, shard_rows: int = SHARD_ROWS
) -> ToxicityModel:
    """Train on all labelled rows whose id hash leaves a remainder but 0 modulo 5.

    ``visits`` is about how many texts training reads, in 4 to 10 rounds over all rows; of many rows it
    reads more, each of them three times or more. ``shard_rows`` bounds what one task trains on between two averages.

    Of rows labelled twice the larger label counts. Rows with remainder 1 choose the thresholds, the
    others train. Without rows of both labels the model answers 0.5 for every text.
    """
    part = remainder(F.col("doc_id"), 5)
    marked = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = marked.where(part != 0).withColumn("part", part.cast("tinyint"))
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known.withColumn("toxic", (F.col("toxic") > 0).cast("tinyint")))

    @pandas_udf("struct<x:binary,size:long>")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_packed(text) for text in batch], columns=["x", "size"])
        give_back_memory()

    trains = F.col("part") != 1
    rows = stored(
        docs.select("doc_id", "text")
        .join(known, "doc_id")
        .select("doc_id", "toxic", "part", F.when(~trains, F.col("text")).alias("text"),
                packed(F.when(trains, F.col("text"))).alias("p"))
        .select("doc_id", "toxic", "part", "text", "p.x", "p.size")
    )
    learn = rows.where(trains)
    n, toxic, size = learn.agg(
        F.count("*"), F.sum((F.col("toxic") > 0).cast("long")), F.sum("size")
    ).first()
    if not n or toxic in (0, n):
        return _start(np.zeros(BUCKETS, bool), 0)[0]
    shards = _sharded(learn, max(math.ceil(n / shard_rows), math.ceil(size / SHARD_BYTES)))
    common = _common(shards)
    weights = _weights(*_start(common, seed=7))
    if n <= shard_rows and size <= SHARD_BYTES:  # nothing to average
        weights = _round(shards, *weights, common, int(np.clip(visits / n, 4, 10)), seed=7)
    else:
        for k in range(int(np.clip(visits / n, 3, 10))):
            weights = _round(shards, *weights, common, 1, seed=7 + k)
    model, _ = _from_weights(*weights)
    # thresholds: scored in tasks and counted, so only counts by language and step of the logit come back
    tuned = rows.where("part = 1").select("toxic", _scored(F.col("text"), model).alias("s"))
    tuned = tuned.groupBy("s.tongue", F.round(F.col("s.logit") * _STEPS).alias("step")).agg(
        F.sum((F.col("toxic") > 0).cast("long")).alias("bad"), F.sum((F.col("toxic") <= 0).cast("long")).alias("good")
    ).toPandas()

    def cut(t: pd.DataFrame) -> float:
        t = t.groupby("step", as_index=False)[["bad", "good"]].sum()
        return _threshold(t.step.to_numpy(float) / _STEPS, t.bad.to_numpy(int), t.good.to_numpy(int))

    overall = cut(tuned) if tuned.bad.sum() and tuned.good.sum() else 0.0
    for k in range(len(_LANGUAGES)):
        own = tuned[tuned.tongue == k]
        bad, good = int(own.bad.sum()), int(own.good.sum())
        model.thresholds[k] = cut(own) if bad and good and bad + good >= 40 else overall
    # a text without words is no toxic text, wherever the cut fell between the few rows that chose it
    empty = float(np.maximum(model.bias, 0.0) @ model.output + model.offset)
    model.thresholds = np.maximum(model.thresholds, empty + 0.5)
    return model


def _scored(text: Column, model: ToxicityModel) -> Column:
    @pandas_udf("struct<logit:double,tongue:int>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = model.tables()
        for batch in batches:
            parts = [
                _logits(model, tables, batch.iloc[at : at + 256].tolist())
                for at in range(0, len(batch), 256)
            ]
            yield pd.DataFrame(
                {
                    "logit": np.concatenate([p[0] for p in parts] or [np.zeros(0)]).astype(float),
                    "tongue": np.concatenate([p[1] for p in parts] or [np.zeros(0)]).astype("int32"),
                }
            )
        give_back_memory()

    return score(text)


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """Score from 0 to 1 of a text column; its language's threshold lies at 0.5."""
    s = _scored(text, model)
    cut = F.array(*[F.lit(float(t)) for t in model.thresholds])

    return F.transform(
        F.array(s), lambda r: 1.0 / (1.0 + F.exp(-(r["logit"] - F.get(cut, r["tongue"]))))
    )[0]


def score_documents(
    docs: DataFrame, labels: DataFrame, model: ToxicityModel | None = None
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null, empty or wordless text is scored like an empty one. Repeated rows are kept; a null id
    counts as empty text for ``held_out``. Only ``doc_id`` and ``text`` of ``docs`` are read, and
    only the text reaches the score.
    """
    model = model or fit(docs, labels)
    return docs.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        toxicity(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that score under 0.5, columns kept."""
    (mark,) = fresh(docs, "toxicity")
    scored = docs.withColumn(mark, toxicity(F.col("text"), fit(docs, labels)))
    return scored.where(F.col(mark) < 0.5).drop(mark)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
