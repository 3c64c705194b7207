"""Ranked lexical search over all documents: MaxScore with bounds for pairs of terms.

Queries are answered in blocks of items. For one block, tasks cut documents into index blocks that
hold, for each term asked, the documents that have it and how much it can give them. For pairs of
terms of one item that are neighbours in frequency, the index also keeps the list of documents that
hold both and the largest sum the two reach together there.

At query time a term's bound is its largest impact in the index block. Two terms together are bounded
by the largest of their joint maximum (documents with both) and their own maxima (documents with
one), which is at most the sum of the two. A query's terms are matched into disjoint pairs with the
largest savings; the cheapest groups whose bounds stay below the score of the k-th best document are
not scanned, only looked up for documents that others proposed, and those that a pair's list does not
hold are given up by the smaller bound. Nothing is skipped that could reach the k-th score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import give_back_memory, stored, table

#: Items searched for in one pass over the documents; more are searched block after block.
ITEMS = 1000
#: An index block ends at this many postings or documents.
POSTINGS = 1_000_000
DOCUMENTS = 65_536
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII; A-Z lowered; null: none."""
    return text.encode("utf-8", "replace").translate(_TERM).split() if isinstance(text, str) else []


@dataclass
class Questions:
    """The items of one pass: numbered terms, and each item's terms with their multiplicities."""

    texts: list[str]
    numbers: dict[bytes, int] = field(default_factory=dict)
    terms: list[np.ndarray] = field(default_factory=list)
    times: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        for text in self.texts:
            counted = Counter(terms_of(text))
            nos = [self.numbers.setdefault(t, len(self.numbers)) for t in counted]
            self.terms.append(np.array(nos, np.int64))
            self.times.append(np.array(list(counted.values()), np.int64))

    def pairs(self, held: np.ndarray) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """Terms of one item that follow each other when sorted by the documents that hold them.

        With each pair come the items it was taken from and how often they hold both.
        """
        out: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for q, (terms, times) in enumerate(zip(self.terms, self.times)):
            order = np.lexsort((terms, -held[terms]))
            rows = list(zip(terms[order].tolist(), times[order].tolist()))
            for (a, m), (b, n) in zip(rows, rows[1:]):
                out.setdefault((min(a, b), max(a, b)), []).append((q, min(m, n)))
        return out


# --- index ------------------------------------------------------------------------------------


def _posting_blocks(docs: DataFrame, asked: dict[bytes, int]) -> DataFrame:
    """One row per index block: documents with a term asked, and per term its places and counts."""
    id_field = docs.schema["doc_id"]
    schema = (
        f"docs array<{id_field.dataType.simpleString()}>, sizes binary, terms binary, ends binary, "
        "places binary, tf binary, with_terms long, n_terms long"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        sizes: list[int] = []
        term, place, tf = [], [], []
        totals = [0, 0]

        def block() -> pa.RecordBatch:
            t = np.array(term, np.int32)
            order = np.argsort(t, kind="stable")
            found, counts = np.unique(t, return_counts=True)
            parts = [
                np.array(sizes, "<i8"), found.astype("<i4"), np.cumsum(counts).astype("<i8"),
                np.array(place, "<u2")[order], np.array(tf, "<i4")[order],
            ]
            columns = [pa.array([ids], pa.list_(id_type))]
            columns += [pa.array([p.tobytes()], pa.binary()) for p in parts]
            columns += [pa.array([n], pa.int64()) for n in totals]
            for held in (ids, sizes, term, place, tf):
                held.clear()
            totals[:] = [0, 0]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                words = terms_of(text.as_py())
                if not words:
                    continue
                totals[0] += 1
                totals[1] += len(words)
                mine = Counter(map(asked.get, words))
                mine.pop(None, None)
                if not mine:
                    continue
                term += mine.keys()
                tf += mine.values()
                place += [len(ids)] * len(mine)
                ids.append(doc_id.as_py())
                sizes.append(len(words))
                if len(ids) == DOCUMENTS or len(term) >= POSTINGS:
                    yield block()
        if totals[0]:
            yield block()
        give_back_memory()

    names = ["docs", "sizes", "terms", "ends", "places", "tf", "with_terms", "n_terms"]
    return docs.select("doc_id", "text").mapInArrow(build, schema)


def _holders(blocks: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term asked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            for terms, ends in zip(batch.column("terms"), batch.column("ends")):
                held[np.frombuffer(terms.as_py(), "<i4")] += np.diff(
                    np.frombuffer(ends.as_py(), "<i8"), prepend=0
                )
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["term", "n"])

    rows = blocks.select("terms", "ends").mapInArrow(count, "term long, n long")
    out = np.zeros(n_terms, np.int64)
    for term, n in rows.groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


@dataclass
class Impacts:
    """What turns counts into integer scores."""

    weight: np.ndarray
    documents: int
    all_terms: int

    @staticmethod
    def of(documents: int, all_terms: int, held: np.ndarray) -> "Impacts":
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()]
        return Impacts(np.array(weight, np.int64), documents, all_terms)

    def parts(self, tf: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A posting's score before its term's weight."""
        m = 100 - 25 + (25 * size * self.documents) // max(self.all_terms, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Block:
    """One index block in a task: postings by term."""

    def __init__(self, row: dict):
        self.docs = row["docs"]
        self.terms = np.frombuffer(row["terms"], "<i4")
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.places = np.frombuffer(row["places"], "<u2")
        self.at = {t: k for k, t in enumerate(self.terms.tolist())}

    def span(self, term: int) -> slice:
        k = self.at.get(term)
        return slice(0, 0) if k is None else slice(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def _indexed(
    blocks: DataFrame, impacts: Impacts, pairs: dict[tuple[int, int], list[tuple[int, int]]], items: int, k: int
) -> DataFrame:
    """Index blocks with impacts, joint lists and maxima of ``pairs``, and each item's sure k-th score."""
    id_type = blocks.schema["docs"].dataType.simpleString()
    schema = (
        f"docs {id_type}, terms binary, ends binary, places binary, parts binary, pair binary, "
        "joint binary, both_ends binary, both binary, sure binary"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                sizes, tf = np.frombuffer(row["sizes"], "<i8"), np.frombuffer(row["tf"], "<i4")
                parts = impacts.parts(tf.astype(np.int64), sizes[block.places])
                scratch = np.zeros(len(block.docs), np.int64)
                sure = np.zeros(items, np.int64)
                pair, joint, both = [], [], []
                for p, ((a, b), holders) in enumerate(pairs.items()):
                    one, two = block.span(a), block.span(b)
                    if one.start == one.stop or two.start == two.stop:
                        continue
                    # parts are positive unless a document is over 10^9 average lengths long
                    scratch[block.places[one]] = parts[one] + 1
                    met = scratch[block.places[two]]
                    scratch[block.places[one]] = 0
                    hit = met > 0
                    sums = (met[hit] - 1) * impacts.weight[a] + parts[two][hit] * impacts.weight[b]
                    pair.append(p)
                    both.append(block.places[two][hit])
                    joint.append(int(sums.max()) if len(sums) else 0)
                    if len(sums) >= k:
                        kth = int(np.partition(sums, -k)[-k])
                        for q, least in holders:
                            sure[q] = max(sure[q], least * kth)
                lists = np.concatenate(both) if both else np.zeros(0, "<u2")
                ends = np.cumsum([len(x) for x in both]) if both else np.zeros(0)
                columns = [
                    row["docs"], row["terms"], row["ends"], row["places"], parts.astype("<i4").tobytes(),
                    np.array(pair, "<i4").tobytes(), np.array(joint, "<i8").tobytes(),
                    ends.astype("<i8").tobytes(), lists.astype("<u2").tobytes(), sure.astype("<i8").tobytes(),
                ]
                types = [batch.schema.field("docs").type] + [pa.binary()] * 9
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], t) for c, t in zip(columns, types)], names
                )
        give_back_memory()

    wanted_columns = ["docs", "sizes", "terms", "ends", "places", "tf"]
    return blocks.select(*wanted_columns).mapInArrow(index, schema)


def _sure_scores(index: DataFrame, items: int) -> np.ndarray:
    """For each item a score that k documents reach for certain, from the joint lists."""

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(items, np.int64)
        for batch in batches:
            for row in batch.column("sure"):
                np.maximum(best, np.frombuffer(row.as_py(), "<i8"), out=best)
        at = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(best[at])], ["q", "n"])

    out = np.zeros(items, np.int64)
    rows = index.select("sure").mapInArrow(largest, "q long, n long")
    for q, n in rows.groupBy("q").agg(F.max("n")).collect():
        out[q] = n
    return out


# --- search -----------------------------------------------------------------------------------


@dataclass
class _Group:
    """One term, or two with their joint list, and the most they can give a document."""

    bound: int
    members: list[tuple[int, int]]  # term, times
    apart: int = 0  # the most they give a document outside the joint list
    both: np.ndarray | None = None


def _groups(index: "_IndexBlock", terms: list[tuple[int, int]]) -> list[_Group]:
    """Disjoint groups of an item's terms by ascending bound, pairs chosen by what they save."""
    bound = {t: n * index.largest[t] for t, n in terms if t in index.largest}
    times, alone = dict(terms), set(bound)
    offers = []
    for a in bound:
        for b, at in index.partners.get(a, ()):
            if b not in bound:
                continue
            least = min(times[a], times[b])
            together = least * index.joint[at]
            together += (times[a] - least) * index.largest[a] + (times[b] - least) * index.largest[b]
            most = max(together, bound[a], bound[b])
            if most < bound[a] + bound[b]:
                offers.append((most - bound[a] - bound[b], a, b, most, at))
    out = []
    for _, a, b, most, at in sorted(offers):
        if a in alone and b in alone:
            alone -= {a, b}
            members = [(a, times[a]), (b, times[b])]
            out.append(_Group(most, members, max(bound[a], bound[b]), index.both(at)))
    out += [_Group(bound[t], [(t, times[t])]) for t in alone]
    return sorted(out, key=lambda g: (g.bound, g.members))


class _IndexBlock(Block):
    def __init__(self, row: dict, weight: np.ndarray, pairs: list[tuple[int, int]]):
        super().__init__(row)
        self.weight = weight
        parts = np.frombuffer(row["parts"], "<i4")
        self.parts = parts
        starts = np.concatenate([np.zeros(1, np.int64), self.ends[:-1]]) if len(self.ends) else []
        best = np.maximum.reduceat(parts, starts).astype(np.int64) if len(parts) else np.zeros(0)
        self.largest = dict(zip(self.at, (best * weight[self.terms]).tolist()))
        self.joint = np.frombuffer(row["joint"], "<i8").tolist()
        self._lists, self._ends = np.frombuffer(row["both"], "<u2"), np.frombuffer(row["both_ends"], "<i8")
        self.partners: dict[int, list[tuple[int, int]]] = {}
        for at, p in enumerate(np.frombuffer(row["pair"], "<i4").tolist()):
            self.partners.setdefault(pairs[p][0], []).append((pairs[p][1], at))

    def both(self, at: int) -> np.ndarray:
        return self._lists[int(self._ends[at - 1]) if at else 0 : int(self._ends[at])]

    def best(self, terms: list[tuple[int, int]], least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and whole scores of all documents that score ``least`` or more (and above 0)."""
        least = max(least, 1)
        groups = _groups(self, terms)
        below, n_below = 0, 0
        while n_below < len(groups) and below + groups[n_below].bound < least:
            below += groups[n_below].bound
            n_below += 1
        if n_below == len(groups):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        total = np.zeros(len(self.docs), np.int64)
        for group in groups[n_below:]:
            for term, n in group.members:
                at = self.span(term)
                total[self.places[at]] += n * self.weight[term] * self.parts[at].astype(np.int64)
        found = np.flatnonzero(total + below >= least)
        score = total[found]
        for group in reversed(groups[:n_below]):
            below -= group.bound
            most = np.full(len(found), group.bound, np.int64)
            if group.both is not None:
                most[~_holds(group.both, found)] = group.apart
            kept = score + most + below >= least
            found, score = found[kept], score[kept]
            for term, n in group.members:
                at = self.span(term)
                places = self.places[at]
                near = np.minimum(np.searchsorted(places, found), len(places) - 1)
                met = places[near] == found
                score[met] += n * self.weight[term] * self.parts[at][near[met]].astype(np.int64)
        kept = score >= least
        return found[kept], score[kept]


def _holds(places: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(places):
        return np.zeros(len(found), bool)
    near = np.minimum(np.searchsorted(places, found), len(places) - 1)
    return places[near] == found


def _order(hit: tuple[int, object]) -> tuple:
    score, doc_id = hit
    return (-score, doc_id is None, 0 if doc_id is None else doc_id)


def _task_hits(
    index: DataFrame, weight: np.ndarray, pairs: list[tuple[int, int]], asked: Questions, sure: np.ndarray, k: int
) -> DataFrame:
    """``q, doc_id, score``: the k best documents of every task for each item."""
    element = index.schema["docs"].dataType.elementType.simpleString()
    questions = [list(zip(t.tolist(), n.tolist())) for t, n in zip(asked.terms, asked.times)]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, object]]] = [[] for _ in questions]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("docs").type.value_type
            for row in batch.to_pylist():
                block = _IndexBlock(row, weight, pairs)
                for q, terms in enumerate(questions):
                    held = best[q]
                    least = max(int(sure[q]), held[-1][0] if len(held) == k else 0)
                    places, scores = block.best(terms, least)
                    if len(places) > k:
                        kth = np.partition(scores, -k)[-k]
                        places, scores = places[scores >= kth], scores[scores >= kth]
                    if len(places):
                        held += zip(scores.tolist(), [block.docs[p] for p in places.tolist()])
                        held.sort(key=_order)
                        del held[k:]
        rows = [(q, d, s) for q, held in enumerate(best) for s, d in held]
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), id_type, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["q", "doc_id", "score"])
        give_back_memory()

    columns = ["docs", "terms", "ends", "places", "parts", "pair", "joint", "both_ends", "both"]
    return index.select(*columns).mapInArrow(search, f"q int, doc_id {element}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    Equal scores go by ascending ``doc_id``, a null id last; repeated document rows are documents of
    their own, and repeated item rows each get their rows. Null and empty texts hold no term; texts
    are read whole; an empty table on either side gives an empty result. Columns other than
    ``doc_id`` and ``text``, and ``item_id`` and ``text`` of the items, are not read.
    """
    spark = docs.sparkSession
    asked_rows = stored(
        items.select("item_id", "text").withColumn("key", F.md5(F.coalesce("text", F.lit(""))))
    )
    texts = asked_rows.select("key", "text").dropDuplicates(["key"])
    passes = max(1, -(-texts.count() // ITEMS))
    results = []
    for number in range(passes):
        share = texts.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == number)
        rows = sorted((r["key"], r["text"] or "") for r in share.collect())
        asked = Questions([text for _, text in rows])
        blocks = stored(_posting_blocks(docs, asked.numbers))
        sums = blocks.agg(F.sum("with_terms"), F.sum("n_terms")).first()
        held = _holders(blocks, len(asked.numbers))
        impacts = Impacts.of(int(sums[0] or 0), int(sums[1] or 0), held)
        pairs = asked.pairs(held)
        index = stored(_indexed(blocks, impacts, pairs, len(rows), k))
        hits = _task_hits(index, impacts.weight, list(pairs), asked, _sure_scores(index, len(rows)), k)
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        keys = spark.createDataFrame([(q, key) for q, (key, _) in enumerate(rows)], "q int, key string")
        results.append(ranked.join(F.broadcast(keys), "q").drop("q"))
    found = results[0]
    for other in results[1:]:
        found = found.union(other)
    return asked_rows.join(found, "key").select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
