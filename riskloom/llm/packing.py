"""Best-fit packing of tokenized documents by exact-complement hashing.

Documents become pieces of at most ``size`` tokens. Only the histogram of piece lengths, at most
``size`` rows, decides how sequences are filled: the longest open length asks for its exact
complement, found as one length, a pair or a triple in an index of their sums; where none exists the
longest fitting length goes in and the rest of the gap asks again. A filling is used as often as the
counts allow, so each one empties at least one length. Pieces then take their places by rank within
their length, which Spark counts over hashed shares of each length.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import give_back_memory, stored, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
_CACHED_WORDS = 250_000
_CACHED_LENGTH = 64
#: Byte-level vocabularies write a byte that has no printable Latin-1 character as one from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_VISIBLE = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: White space that is no blank becomes one; A-Z are lowered in the first table only.
_KEEP = bytes(32 if b in (9, 10, 13) else b for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in _KEEP)
_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder(dict):
    """Token ids of whole texts, as little-endian 32-bit bytes.

    The vocabulary's rules never join characters across a blank and ignore the case of A-Z, so ids
    are looked up per blank-separated, lower-cased chunk and only unseen chunks meet the tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.word = self.tokenizer.model.tokenize

    def _encode(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if text[-1] in ".," and text[-2:-1].lower().isalpha():  # the mark is a word of its own
            return self[chunk[:-1]] + self[chunk[-1:]]
        if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
            ids = [t.id for t in self.word(chunk.decode("latin-1").translate(_VISIBLE))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self._encode(chunk) if chunk else b""
        if len(chunk) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[chunk] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        if not isinstance(text, str):
            return b""
        raw = text.encode("utf-8", "replace")
        # next to combining marks a letter's case can matter to normalization, so it stays
        plain = b"\xcc" not in raw and b"\xcd" not in raw
        return b"".join(map(self.__getitem__, raw.translate(_LOWER if plain else _KEEP).split(b" ")))


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, path: str, size: int = 4096, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids and the end id, cut at ``size``."""

    @pandas_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path).ids
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            out = []
            for text in batch:
                ids = encode(text) + end
                rows = []
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
                out.append(
                    [dict(zip(("piece", "start", "length", "ids_crc32"), row)) for row in rows]
                )
            yield pd.Series(out)
        give_back_memory()

    return docs.select("doc_id", F.explode(cut("text")).alias("p")).select("doc_id", "p.*")


# --- which lengths share a sequence -----------------------------------------------------------


def _largest(bits: int) -> int:
    return bits.bit_length() - 1


class Lengths:
    """Counts of open lengths, and an index of the sums of one, two and three of them."""

    def __init__(self, counts: dict[int, int]):
        self.left = Counter({k: v for k, v in counts.items() if v > 0})
        self.open = sum(1 << k for k in self.left)
        self._pairs: int | None = None

    def take(self, lengths: list[int], times: int) -> None:
        for k, m in Counter(lengths).items():
            self.left[k] -= m * times
            if not self.left[k]:
                del self.left[k]
                self.open ^= 1 << k
                self._pairs = None

    def pair_sums(self) -> int:
        if self._pairs is None:
            sums = 0
            for k in self.left:
                sums |= self.open << k
            self._pairs = sums
        return self._pairs

    def enough(self, lengths: list[int]) -> bool:
        return all(self.left[k] >= m for k, m in Counter(lengths).items())

    def _pair(self, gap: int, taken: list[int], most: int) -> list[int] | None:
        """Two lengths that sum to ``gap``, the first at most ``most``, the longest first."""
        mirrored = _reversed(self.open, gap)
        both = self.open & mirrored & ((1 << (min(most, gap) + 1)) - 1)
        while both:
            b = _largest(both)
            if 2 * b < gap:
                return None
            if self.enough([*taken, b, gap - b]):
                return [b, gap - b]
            both ^= 1 << b
        return None

    def complement(self, gap: int, taken: list[int]) -> list[int] | None:
        """One, two or three lengths that fill ``gap`` exactly beside what is already taken."""
        if self.open >> gap & 1 and self.enough([*taken, gap]):
            return [gap]
        if not self.pair_sums() >> gap & 1:
            pair = None
        else:
            pair = self._pair(gap, taken, gap)
        if pair:
            return pair
        firsts = self.open & _reversed(self.pair_sums(), gap)
        while firsts:
            b = _largest(firsts)
            if 3 * b < gap:
                return None
            if self.enough([*taken, b]):
                pair = self._pair(gap - b, [*taken, b], b)
                if pair:
                    return [b, *pair]
            firsts ^= 1 << b
        return None

    def longest(self, most: int, taken: list[int]) -> int | None:
        fits = self.open & ((1 << (most + 1)) - 1)
        while fits:
            k = _largest(fits)
            if self.enough([*taken, k]):
                return k
            fits ^= 1 << k
        return None


def _reversed(bits: int, gap: int) -> int:
    """Bit k of the result is bit ``gap - k`` of ``bits``, for k from 0 to ``gap``."""
    low = bits & ((1 << (gap + 1)) - 1)
    return int(format(low, f"0{gap + 1}b")[::-1], 2)


def fillings(counts: dict[int, int], size: int = 4096) -> list[tuple[list[int], int]]:
    """``(lengths of one sequence, times)`` that use up ``counts``."""
    lengths, out = Lengths(counts), []
    while lengths.left:
        chosen = [_largest(lengths.open)]
        gap = size - chosen[0]
        while gap:
            exact = lengths.complement(gap, chosen)
            if exact:
                chosen += exact
                break
            best = lengths.longest(gap, chosen)
            if best is None:
                break
            chosen.append(best)
            gap -= best
        times = min(lengths.left[k] // m for k, m in Counter(chosen).items())
        lengths.take(chosen, times)
        out.append((chosen, times))
    return out


def slots(counts: dict[int, int], size: int = 4096) -> np.ndarray:
    """Rows ``length, first rank, times, first sequence, first offset``, sorted by length and rank.

    Ranks ``first .. first + times * m`` of a length belong to one filling that holds it m times.
    """
    rows, used, sequence = [], Counter(), 0
    for chosen, times in fillings(counts, size):
        offset = 0
        for k, m in sorted(Counter(chosen).items()):
            rows.append((k, used[k], times, sequence, offset))
            used[k] += m * times
            offset += m * k
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(found: DataFrame, size: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces.

    The histogram is the only thing that reaches the driver (at most ``size`` rows), and the slots
    broadcast with the last step follow from it, not from the number of pieces.
    """
    histogram = {k: n for k, n in found.groupBy("length").count().collect()}
    plan = slots(histogram, size)
    # a length with n pieces is dealt over sqrt(n) shares of sqrt(n) pieces
    shares = found.sparkSession.createDataFrame(
        [(k, max(1, int(n**0.5))) for k, n in histogram.items()], "length long, shares long"
    )
    salted = found.join(F.broadcast(shares), "length").withColumn(
        "share", F.expr("pmod(xxhash64(doc_id, piece, ids_crc32), shares)")
    )
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        salted.groupBy("length", "share")
        .count()
        .select(
            "length", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead")
        )
    )
    within = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("nth", F.row_number().over(within) - 1)
        .join(starts, ["length", "share"])
        .withColumn("nth", F.col("nth") + F.col("ahead"))
    )

    @pandas_udf("struct<sequence_id:long,offset:long>")
    def slot(length: pd.Series, nth: pd.Series) -> pd.DataFrame:
        length, nth = length.to_numpy(np.int64), nth.to_numpy(np.int64)
        wide = np.int64(1) << 44
        at = np.searchsorted(plan[:, 0] * wide + plan[:, 1], length * wide + nth, side="right") - 1
        _, first, times, sequence, offset = plan[at].T
        turn, which = np.divmod(nth - first, times)
        return pd.DataFrame({"sequence_id": sequence + which, "offset": offset + turn * length})

    return ranked.withColumn("slot", slot("length", "nth")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "slot.sequence_id", "slot.offset"
    )


def pack(
    docs: DataFrame, path: str | None = None, size: int = 4096, end_id: int = END_ID
) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` tokens, one row per piece.

    A null or empty text is one piece that holds the end id only. Repeated rows and null ids are
    packed like any other; rows equal in every column may swap places. Columns other than ``doc_id``
    and ``text`` are not read. An empty table gives an empty result. Strings of special tokens in a
    text are ordinary text.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    return place(stored(pieces(docs, path, size, end_id)), size)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
