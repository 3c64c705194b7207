from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm import packing
from tests.llm.cases import awkward, corpus, table

PATH = public_tokenizers.path(packing.VOCABULARY)


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_cached_words_give_the_tokenizers_ids(plain):
    encode = packing.WordEncoder(PATH).ids
    rng = random.Random(1)
    letters = "aAbZ'sSéÉ ̱́̇İHK.,!<|>endoftext09 \n\t\x0b\x0c\x1c\x85 ßΣς漢²½ǅ"
    for _ in range(8000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(25)))
        assert encode(text) == np.array(plain(text), "<u4").tobytes(), repr(text)


def check(rows, docs, plain, size):
    """Every document whole and in order, pieces gapless, no sequence too long."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    wanted = defaultdict(list)
    for d in docs:
        wanted[d[0]].append(plain(d[1]) + [1])
    for doc_id, texts in wanted.items():
        pieces = []
        for ids in texts:
            for k, at in enumerate(range(0, len(ids), size)):
                part = ids[at : at + size]
                pieces.append((k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
        got = [(r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc_id]]
        assert sorted(got) == sorted(pieces)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r.length for r in rows)
    return len(sequences), -(-total // size)


@pytest.mark.parametrize("size", [64, 4096])
def test_awkward_rows_are_packed_whole(spark, plain, size):
    docs = awkward() + corpus(n=60)
    rows = packing.pack(table(spark, docs), PATH, size).collect()
    used, least = check(rows, docs, plain, size)
    assert used <= least * 1.1 + 1


def test_many_rows_of_one_length(spark, plain):
    docs = [(i, "the same length each", "en", "s", 1, 0.0, "", "", 0) for i in range(3000)]
    rows = packing.pack(table(spark, docs), PATH, 128).collect()
    used, least = check(rows, docs, plain, 128)
    assert used <= least + 1 + least // 20


def test_empty_table(spark):
    assert packing.pack(table(spark, []), PATH).collect() == []


def test_fillings_use_exactly_what_there_is():
    rng = random.Random(5)
    for _ in range(60):
        size = rng.choice([16, 50, 200])
        counts = {rng.randrange(1, size + 1): rng.randrange(1, 40) for _ in range(rng.randrange(1, 30))}
        left = dict(counts)
        for chosen, times in packing.fillings(counts, size):
            assert sum(chosen) <= size and times >= 1
            for k in chosen:
                left[k] -= times
        assert not any(left.values())


def test_complements_are_found_when_they_exist():
    for counts, size in (({7: 2, 3: 2}, 10), ({6: 1, 3: 1, 1: 1}, 10), ({5: 1, 2: 1, 1: 1, 8: 1}, 8)):
        assert all(sum(c) == size for c, _ in packing.fillings(counts, size))
