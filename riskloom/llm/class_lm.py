"""Language-model scores from a class bigram model whose classes come from exchange clustering.

Probability of a word: its class after the class before, then the word within its class. Frequent
words are items of their own; all other words, unseen ones included, belong to an item given by
their last three bytes, and share its probability by discounted counts. Items are what exchange
moves between classes: in each round Spark counts, over the whole training text, each item's
neighbours by class, and every second item moves to the class that raises the likelihood most.

Vocabulary and counts live in Spark tables. Only data bounded by ``ITEMS``, ``UNITS``, ``CLASSES``
and ``LOOKUP`` reaches the driver or is sent to tasks; words beyond meet their counts in a join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import encoded, remainder, stored, table

#: Most frequent words that are clustered one by one; all others are clustered by their ending.
ITEMS = 8192
UNITS = 1024
CLASSES = 48
ROUNDS = 8
#: Most frequent words whose counts travel to the tasks; the others are joined.
LOOKUP = 200_000
SMOOTHING = 20.0
#: The token behind each text. No word is empty, so the empty word stands for it.
END = b""
_FLUSH = 200_000


def unit_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % UNITS


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def emit():
        words = list(counts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(words, pa.binary()),
                pa.array([unit_of(w) for w in words], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["word", "unit", "n"],
        )

    for batch in batches:
        for text in batch.column("text"):
            counts.update(encoded(text.as_py()).split())
            counts[END] += 1
            if len(counts) > _FLUSH:
                yield emit()
                counts.clear()
    if counts:
        yield emit()


def vocabulary(training: DataFrame) -> DataFrame:
    """``word, unit, n`` of all training tokens, the end token included, as a written table."""
    parts = training.select("text").mapInArrow(_count_words, "word binary, unit int, n long")
    return stored(parts.groupBy("word", "unit").agg(F.sum("n").alias("n")))


def most_frequent(words: DataFrame, most: int) -> list[tuple[bytes, int, int]]:
    """``(word, unit, n)`` of highest count, at most ``most``; of words with the last count some, by hash.

    The cut is found from how many words lie in each eighth of a power of two, then from how many have
    each count in the eighth where it falls; so only about the words wanted reach the driver, not the
    best of every task.
    """
    eighth = F.floor(F.log2("n") * 8)

    def split(sizes: list[tuple[int, int]], room: int) -> tuple[int | None, int]:
        """The value at which ``room`` ends (None: all fit) and what is left of it there."""
        for value, k in sorted(sizes, reverse=True):
            if k > room:
                return value, room
            room -= k
        return None, room

    edge, room = split(words.groupBy(eighth.alias("e")).count().collect(), most)
    wanted = F.lit(True)
    if edge is not None:
        inside = words.where(eighth == edge)
        last, room = split(inside.groupBy("n").count().collect(), room)
        ties = inside.where(F.col("n") == last).count()
        # the words of the last count that fit, and a few more, which are cut below
        share = min(1.0, (room + 4.0 * math.sqrt(room)) / ties)
        draw = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
        wanted = (F.col("n") > last) | ((F.col("n") == last) & draw)
    # Arrow columns: rows of Python objects would take ten times the memory
    found = words.where(wanted).select("word", "unit", "n").toArrow()
    found = found.sort_by([("n", "descending"), ("word", "ascending")]).slice(0, most)
    return list(zip(*(found.column(c).to_pylist() for c in ("word", "unit", "n"))))


class _Numbers(dict):
    """Word → item number; words outside the list get their unit's number, and are remembered."""

    def __init__(self, head: list[bytes]):
        super().__init__({w: k for k, w in enumerate(head)})
        self.head, self.limit = len(head), len(head) + 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            for w in [w for w, k in self.items() if k >= self.head]:
                del self[w]
        self[word] = number = self.head + unit_of(word)
        return number


@dataclass
class ClassModel:
    head: list[bytes]  # END first
    classes: np.ndarray  # class of each item (head, then units)
    step: np.ndarray  # log10 P(class | class before)
    item: np.ndarray  # log10 P(item | its class)
    unit_tokens: np.ndarray
    unit_words: np.ndarray
    discount: float
    tokens: int
    distinct: int
    bigram_likelihood: list[float]

    def unseen(self) -> np.ndarray:
        """log10 of the share an ending keeps for unseen words."""
        mass = np.where(
            self.unit_tokens > 0,
            self.discount * self.unit_words / np.maximum(self.unit_tokens, 1),
            1.0,
        )
        return np.log10(mass)


# --- exchange ---------------------------------------------------------------------------------


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def _likelihood(pairs: np.ndarray) -> float:
    rows, cols = pairs.sum(1), pairs.sum(0)
    return float(_xlogx(pairs).sum() - _xlogx(rows).sum() - _xlogx(cols).sum())


def _by_class(right: np.ndarray, classes: np.ndarray) -> np.ndarray:
    pairs = np.zeros((CLASSES, CLASSES))
    np.add.at(pairs, classes, right)
    return pairs


def exchange(
    classes: np.ndarray, left: np.ndarray, right: np.ndarray, movable: np.ndarray
) -> np.ndarray:
    """Move each of ``movable`` to the class with the largest likelihood, one after the other.

    ``left`` and ``right`` count each item's neighbours by class (as of the start of the round).
    """
    classes = classes.copy()
    pairs = _by_class(right, classes)
    rows, cols = pairs.sum(1), pairs.sum(0)
    for w in movable:
        r, c = right[w], left[w]
        n_row, n_col = r.sum(), c.sum()
        if not n_row and not n_col:
            continue
        own = classes[w]
        pairs[own] -= r
        pairs[:, own] -= c
        np.maximum(pairs, 0.0, out=pairs)
        rows[own] -= n_row
        cols[own] -= n_col
        at, to = np.flatnonzero(r), np.flatnonzero(c)
        gain = (_xlogx(pairs[:, at] + r[at]) - _xlogx(pairs[:, at])).sum(1)
        gain += (_xlogx(pairs[to] + c[to][:, None]) - _xlogx(pairs[to])).sum(0)
        gain -= _xlogx(rows + n_row) - _xlogx(rows) + _xlogx(cols + n_col) - _xlogx(cols)
        gain[0] = -np.inf  # the end token's class is its own
        best = int(gain.argmax())
        classes[w] = best
        pairs[best] += r
        pairs[:, best] += c
        rows[best] += n_row
        cols[best] += n_col
    return classes


def _neighbours(ids: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each item's left and right neighbours by class, over all training texts."""
    items = len(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = items * CLASSES
        total = np.zeros(2 * size, np.int64)
        for batch in batches:
            for text in batch.column("items"):
                seq = np.frombuffer(text.as_buffer(), "<u2").astype(np.int64)
                tags = classes[seq]
                total[:size] += np.bincount(seq[1:] * CLASSES + tags[:-1], minlength=size)
                total[size:] += np.bincount(seq[:-1] * CLASSES + tags[1:], minlength=size)
        at = np.flatnonzero(total)
        for low in range(0, len(at), 1 << 16):
            some = at[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "n"])

    found = ids.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(2 * items * CLASSES)
    total[found.column("at").to_numpy()] = found.column("n").to_numpy()
    left, right = total.reshape(2, items, CLASSES)
    return left, right


def item_sequences(training: DataFrame, head: list[bytes]) -> DataFrame:
    """Blocks of item numbers of whole texts, each text between end tokens, as 16-bit binaries."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(head)
        for batch in batches:
            blocks, block, load = [], [np.zeros(1, "<u2")], 0
            for text in batch.column("text"):
                words = encoded(text.as_py()).split()
                ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                block += [ids.astype("<u2"), np.zeros(1, "<u2")]
                load += len(words)
                if load > 1 << 18:
                    blocks.append(np.concatenate(block).tobytes())
                    block, load = [np.zeros(1, "<u2")], 0
            blocks.append(np.concatenate(block).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["items"])

    return stored(training.select("text").mapInArrow(number, "items binary"))


def fit(training: DataFrame, words: DataFrame, rounds: int = ROUNDS) -> ClassModel:
    """Cluster items over all training texts and take the model's counts from the same texts."""
    ends = F.col("word") == F.lit(END)
    totals = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"),
        F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long")),
    ).first()
    tokens, distinct, once, twice = (int(x or 0) for x in totals)
    top = most_frequent(words.where(~ends), ITEMS - 1)
    per_unit = {
        u: (n, k)
        for u, n, k in words.where(~ends).groupBy("unit").agg(F.sum("n"), F.count("*")).collect()
    }
    head = [END, *[w for w, _, _ in top]]
    unit_tokens, unit_words = np.zeros(UNITS), np.zeros(UNITS)
    for u, (n, k) in per_unit.items():
        unit_tokens[u], unit_words[u] = n, k
    for _, u, n in top:
        unit_tokens[u] -= n
        unit_words[u] -= 1
    texts = tokens - sum(n for n, _ in per_unit.values())
    counts = np.r_[texts, [n for _, _, n in top], unit_tokens].astype(float)
    items = len(counts)

    # the most frequent words start alone, all other items together
    classes = np.full(items, CLASSES - 1)
    classes[: min(len(head), CLASSES - 1)] = np.arange(min(len(head), CLASSES - 1))
    order = np.argsort(-counts, kind="stable")
    order = order[order != 0]
    ids = item_sequences(training, head)
    best, history = None, []
    for k in range(rounds + 1):
        left, right = _neighbours(ids, classes)
        pairs = _by_class(right, classes)
        history.append(_likelihood(pairs))
        if best is None or history[-1] >= best[0]:
            best = (history[-1], classes, pairs)
        if k < rounds:
            # neighbours' classes move too; moving every second item keeps counts close to true
            movable = order if k == 0 else order[(order + k) % 2 == 0]
            classes = exchange(classes, left, right, movable)
    _, classes, pairs = best
    share = (pairs.sum(0) + 1.0) / (pairs.sum() + CLASSES)
    step = (pairs + SMOOTHING * share) / (pairs.sum(1, keepdims=True) + SMOOTHING)
    in_class = np.bincount(classes, counts + 0.5, CLASSES)
    return ClassModel(
        head, classes, np.log10(step), np.log10((counts + 0.5) / in_class[classes]),
        unit_tokens, unit_words, once / (once + 2.0 * twice) if once else 0.5,
        tokens, distinct, history,
    )


# --- scores -----------------------------------------------------------------------------------

_PART = (
    "doc_id {id}, digest binary, held_out boolean, word binary, unit int, n long, n_tokens long, "
    "n_known long, base_score double, score double"
)


def _parts(docs: DataFrame, model: ClassModel, counts: dict[bytes, int]) -> DataFrame:
    """A row for each text with what tasks know, and rows for words whose counts are elsewhere."""
    schema = _PART.format(id=docs.schema["doc_id"].dataType.simpleString())
    room = math.log10(model.tokens + model.distinct + 1)
    head = len(model.head)
    unseen, discount, unit_tokens = model.unseen(), model.discount, model.unit_tokens

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(model.head)
        known_base = np.array([math.log10(counts[w] + 1) - room for w in model.head] or [0.0])
        for batch in batches:
            columns: dict[str, list] = {k: [] for k in names}

            def row(*values):
                for k, v in zip(names, values):
                    columns[k].append(v)

            for doc_id, text, out in zip(
                batch.column("doc_id"), batch.column("text"), batch.column("held_out")
            ):
                doc_id, out, raw = doc_id.as_py(), out.as_py(), encoded(text.as_py())
                words = raw.split()
                seq = np.zeros(len(words) + 2, np.int64)
                seq[1:-1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                tags = model.classes[seq]
                total = float(model.step[tags[:-1], tags[1:]].sum() + model.item[seq[1:]].sum())
                inside = seq[1:] < head
                base = float(known_base[seq[1:][inside]].sum())
                known = int(inside.sum()) if model.tokens else 0
                digest = xxhash.xxh3_128_digest(raw if isinstance(text.as_py(), str) else b"\x00")
                rest = Counter(words[k] for k in np.flatnonzero(~inside[:-1]).tolist())
                for w, m in rest.items():
                    n = counts.get(w)
                    if n is None:
                        row(doc_id, digest, out, w, unit_of(w), m, 0, 0, 0.0, 0.0)
                    else:
                        known += m
                        base += m * (math.log10(n + 1) - room)
                        total += m * math.log10((n - discount) / unit_tokens[unit_of(w)])
                row(doc_id, digest, out, None, None, None, len(words) + 1, known, base, total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[k], t) for k, t in zip(names, types)], names
            )

    names = ["doc_id", "digest", "held_out", "word", "unit", "n", "n_tokens", "n_known", "base_score", "score"]
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [
        id_type[docs.schema["doc_id"].dataType.simpleString()], pa.binary(), pa.bool_(), pa.binary(),
        pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
    ]
    return docs.mapInArrow(score, schema)


def score_documents(
    docs: DataFrame, modulus: int = 7, held_out: int = 2, rounds: int = ROUNDS
) -> DataFrame:
    """One row per document with token counts, the unigram base and the class model's score.

    Null and empty texts are one end token. Words unseen in training count as one kind within their
    ending. A null id counts as empty text for ``held_out``. Rows equal in id and text get equal rows.
    Without training texts every word is unseen and the model rests on its smoothing. Columns other
    than ``doc_id`` (long, int or string) and ``text`` are not read.
    """
    read = docs.select(
        "doc_id", "text", (remainder(F.col("doc_id"), modulus) == held_out).alias("held_out")
    )
    training = read.where(~F.col("held_out"))
    words = vocabulary(training)
    model = fit(training, words, rounds)
    counts = {w: n for w, _, n in most_frequent(words, max(ITEMS, LOOKUP))}
    counts.setdefault(END, 0)
    parts = stored(_parts(read, model, counts))

    spark = docs.sparkSession
    units = F.broadcast(
        spark.createDataFrame(
            [(u, float(t), float(s)) for u, (t, s) in enumerate(zip(model.unit_tokens, model.unseen()))],
            "unit int, unit_tokens double, unseen double",
        )
    )
    room = math.log10(model.tokens + model.distinct + 1)
    seen = words.select("word", F.col("n").alias("seen"))
    emitted = F.when(
        F.col("seen").isNotNull(), F.log10((F.col("seen") - model.discount) / F.col("unit_tokens"))
    ).otherwise(F.col("unseen"))
    others = (
        parts.where("word IS NOT NULL")
        .join(seen, "word", "left")
        .join(units, "unit")
        .select(
            "doc_id", "digest", "held_out", F.lit(0).alias("texts"), F.lit(0).cast("long").alias("n_tokens"),
            F.when(F.col("seen").isNotNull(), F.col("n")).otherwise(0).alias("n_known"),
            (F.col("n") * (F.log10(F.coalesce("seen", F.lit(0)) + 1) - room)).alias("base_score"),
            (F.col("n") * emitted).alias("score"),
        )
    )
    own = parts.where("word IS NULL").select(
        "doc_id", "digest", "held_out", F.lit(1).alias("texts"), "n_tokens", "n_known", "base_score", "score"
    )
    each = (
        own.union(others)
        .groupBy("doc_id", "digest", "held_out")
        .agg(*[F.sum(c).alias(c) for c in ("texts", "n_tokens", "n_known", "base_score", "score")])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("texts").cast("int"))))
    )
    return each.select(
        "doc_id", "held_out",
        (F.col("n_tokens") / F.col("texts")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("texts")).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("texts")).alias("base_score"),
        (F.col("score") / F.col("texts")).alias("score"),
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op2_class_lm(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
