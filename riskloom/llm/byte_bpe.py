"""Byte-level BPE encoding and decoding, by backtracking from longest matches.

A run of tokens is what the merges leave of their bytes if and only if the merges of every two
neighbours' bytes leave those two: merges inside tokens never see the others, so the first merge
across a border would also happen when the two stand alone. An encoder can therefore go from left to
right, take the longest token at each place, and check it against the token before; whether two
tokens are compatible is remembered. Where a token does not fit, the next shorter one is tried, and
where none fits the token before gives way. The tokens up to a place are unique, so a place given up
once is never tried again and the work is linear in the bytes.

The tokens at every place come from an Aho-Corasick automaton over bytes written as Latin-1. Texts
are first cut by a pattern into pieces; pieces repeat, so their ids are remembered too.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import fresh, give_back_memory, table

RANKS = "byte_bpe_50k.tiktoken"
#: Remembered pieces and pairs of tokens of one Python worker; beyond them the memory starts anew.
_PIECES = 200_000
_PAIRS = 400_000
#: Longer pieces are not remembered.
_PIECE_BYTES = 64
_CODECS: dict[tuple[str, str], "ByteBpe"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes → rank, from lines of a base64 token and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token}


class ByteBpe(dict):
    """Encoder and decoder of one rank file; every single byte must have a rank.

    As a dictionary it remembers the ids of pieces.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{len(missing)} of 256 bytes have no rank")
        super().__init__()
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        # blanks are those of Unicode's property, not those this library's own class counts
        blank = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.split = regex.compile(blank).findall
        self._shorter: dict[int, int | None] = {}
        self._stable: dict[int, bool] = {}
        self._after: dict[int, int | None] = {}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """All tokens as Latin-1; a decoder never builds it."""
        out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.ranks.items():
            out.add_word(token.decode("latin-1"), rank)
        out.make_automaton()
        return out

    def merged(self, raw: bytes) -> list[int]:
        """Ranks left when the lowest-ranked neighbours merge, the leftmost first, until none can."""
        parts = [raw[k : k + 1] for k in range(len(raw))]
        while len(parts) > 1:
            joined = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            best = min((r for r in joined if r is not None), default=None)
            if best is None:
                break
            k = joined.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def stable(self, token: int) -> bool:
        """Whether the merges can build ``token`` from its bytes at all."""
        known = self._stable.get(token)
        if known is None:
            known = self._stable[token] = self.merged(self.tokens[token]) == [token]
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens can stand beside each other: their bytes' merges leave just them."""
        return self.merged(self.tokens[left] + self.tokens[right]) == [left, right]

    def after(self, left: int, token: int) -> int | None:
        """The longest token that begins ``token`` (itself included) and can stand behind ``left``."""
        key = left << 32 | token
        known = self._after.get(key, -1)
        if known == -1:
            known = token
            while known is not None and not self.fits(left, known):
                known = self.shorter(known)
            if len(self._after) >= _PAIRS:
                self._after.clear()
            self._after[key] = known
        return known

    def shorter(self, token: int) -> int | None:
        """The longest token the merges can build that begins ``token`` and is shorter."""
        if token not in self._shorter:
            raw, found = self.tokens[token], None
            for size in range(len(raw) - 1, 0, -1):
                rank = self.ranks.get(raw[:size])
                if rank is not None and self.stable(rank):
                    found = rank
                    break
            self._shorter[token] = found
        return self._shorter[token]

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one piece. A piece that is a token is that token, whatever the merges say."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        latin, after = raw.decode("latin-1"), self._after
        # the longest matches one after the other, as far as neighbours fit
        greedy = [token for _, token in self.automaton.iter_long(latin)]
        last, good = greedy[0], 1
        for token in greedy[1:]:
            next_ = after.get(last << 32 | token, -1)
            if (self.after(last, token) if next_ == -1 else next_) != token:
                break
            last = token
            good += 1
        if good == len(greedy):
            return greedy
        # pairs vouch for the tokens before the first misfit, a single token stands for itself
        out, token = greedy[:good], greedy[good]
        if good == 1 and not self.stable(out[0]):
            token = self.shorter(out.pop())
        place = sum(map(self.sizes.__getitem__, out))
        return self._continued(latin, out, place, token)

    def _continued(self, latin: str, out: list[int], place: int, token: int | None) -> list[int]:
        """Go on behind ``out``, which ends at ``place``, with ``token`` or a beginning of it."""
        size, sizes, after = len(latin), self.sizes, self._after
        open_ = bytearray(b"\x01") * (size + 1)
        while place < size:
            if out and token is not None:
                next_ = after.get(out[-1] << 32 | token, -1)
                token = self.after(out[-1], token) if next_ == -1 else next_
            while token is not None and not open_[place + sizes[token]]:
                token = self.shorter(token)
                if out and token is not None:
                    token = self.after(out[-1], token)
            if token is None:
                # nothing follows the tokens up to here, and no other tokens lead here
                open_[place] = 0
                last = out.pop()
                place -= sizes[last]
                token = self.shorter(last)
            else:
                out.append(token)
                place += sizes[token]
                if place < size:
                    token = next(self.automaton.iter_long(latin, place))[1]
        return out

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "replace")
        ids = array("I", self.encode_piece(raw)).tobytes()
        if len(raw) <= _PIECE_BYTES:
            if len(self) >= _PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit integers; empty for null."""
        return b"".join(map(self.__getitem__, self.split(text))) if isinstance(text, str) else b""

    def decode(self, ids: bytes | None) -> bytes:
        """The bytes of ``ids``; an id without a token is an error."""
        if not ids:
            return b""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(path: str, pattern: str) -> ByteBpe:
    """The codec of a rank file, built once in a Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def ids_of(text: Column, path: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Binary column: ids of whole texts as little-endian unsigned 32-bit integers, none for null."""

    @pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode_text = codec(path, pattern).encode
        for texts in batches:
            yield pd.Series([encode_text(t) for t in texts], dtype=object)
        give_back_memory()

    return encode(text)


def bytes_of(ids: Column, path: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Binary column: the bytes that ids of ``ids_of`` stand for; none for null."""

    @pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decode_ids = codec(path, pattern).decode
        for rows in batches:
            yield pd.Series([decode_ids(r) for r in rows], dtype=object)

    return decode(ids)


def encoded_documents(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded`` (underscores in front where ``docs`` has such names).

    Row by row and without a shuffle, so ties, repeated rows and hot keys change nothing: equal texts
    get equal ids. Null and empty texts have no ids; texts of any length are encoded whole; an empty
    table gives an empty one; other columns pass through unread.
    """
    ids, decoded = fresh(docs, "ids", "decoded")
    coded = docs.withColumn(ids, ids_of(F.col("text"), path))
    return coded.withColumn(decoded, bytes_of(F.col(ids), path))


def op12_byte_bpe(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encoded_documents(docs, public_tokenizers.path(RANKS))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
