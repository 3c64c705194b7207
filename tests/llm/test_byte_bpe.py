from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from riskloom.llm import byte_bpe
from tests.llm.cases import awkward, corpus, table

PATH = public_tokenizers.path(byte_bpe.RANKS)


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def random_text(rng):
    alphabets = [
        "ab", "aeiounrst", "xyzXYZ09", " \n\t\r\x0b\x0c", "'sdmlrvte ", "\x1c\x1d\x1e\x1f\x85\xa0 　 a",
        "éßñçüÀÉİıſK", "漢字仮名交じり文", "🙂👩‍🚀̧́", "!?#@$%^&*()_+-=", "ٱلْعَرَبِيَّةُ٣٤", "½²Ⅷ५",
        "<|endoftext|>", "\x00�",
    ]
    out = []
    for _ in range(rng.randrange(1, 12)):
        letters = rng.choice(alphabets)
        out.append("".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))))
    return rng.choice(["", " "]).join(out)


def test_random_texts_as_the_library_encodes_them(codec, reference):
    rng = random.Random(5)
    for _ in range(1500):
        text = random_text(rng)
        ids = np.frombuffer(codec.encode(text), "<u4").tolist()
        assert ids == reference.encode_ordinary(text), text
        assert codec.decode(codec.encode(text)) == text.encode()


def test_tokens_side_by_side(codec, reference):
    """Pieces glued from tokens themselves are where greedy encoding goes wrong."""
    rng = random.Random(6)
    words = [t.decode() for t in codec.ranks if t.isalpha() and t.isascii()]
    greedy = 0
    for _ in range(1500):
        text = "".join(rng.choice(words) for _ in range(rng.randrange(2, 6)))
        ids = codec.encode_piece(text.encode())
        assert ids == reference.encode_ordinary(text)
        greedy += ids[0] != next(codec.automaton.iter_long(text))[1]
    assert greedy > 40  # the backtracking had work to do


def test_longest_tokens(codec):
    rng = random.Random(8)
    for _ in range(500):
        latin = random_text(rng).encode().decode("latin-1")
        for place in range(len(latin)):
            sizes = [k for k in range(1, 130) if latin[place : place + k].encode("latin-1") in codec.ranks]
            most = max(k for k in sizes if place + k <= len(latin))
            token = next(codec.automaton.iter_long(latin, place))[1]
            assert codec.tokens[token] == latin[place : place + most].encode("latin-1")


def test_any_ranks():
    """Merge tables drawn at random, unreachable tokens among them, against merging one by one."""
    rng = random.Random(7)
    for _ in range(60):
        tokens = [bytes([b]) for b in range(256)]
        for _ in range(40):
            joined = rng.choice(tokens[96:102] + tokens[256:]) + rng.choice(tokens[96:102] + tokens[256:])
            if joined not in tokens and len(joined) < 12:
                tokens.append(joined)
        for _ in range(3):
            odd = bytes(rng.choice(b"`abcde") for _ in range(5))
            if odd not in tokens:
                tokens.append(odd)
        order = tokens[256:]
        rng.shuffle(order)
        codec = byte_bpe.ByteBpe({t: k for k, t in enumerate(tokens[:256] + order)}, r".+")
        for _ in range(60):
            raw = bytes(rng.choice(b"`abcde") for _ in range(rng.randrange(1, 40)))
            want = [codec.ranks[raw]] if raw in codec.ranks else codec.merged(raw)
            assert codec.encode_piece(raw) == want


def test_long_pieces(codec, reference):
    for text in ("x" * 20_000, "ab" * 9_000 + "q", " " * 5_000 + "end", "ahaha" * 3_000):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_memories_start_anew(monkeypatch, reference):
    monkeypatch.setattr(byte_bpe, "_PIECES", 5)
    monkeypatch.setattr(byte_bpe, "_PAIRS", 3)
    small = byte_bpe.ByteBpe(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    text = corpus(n=1)[0][1]
    assert np.frombuffer(small.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_ranks_without_all_bytes():
    with pytest.raises(ValueError, match="255 of 256"):
        byte_bpe.ByteBpe({b"a": 0}, ".")


def test_documents(spark, reference, tmp_path):
    rows = awkward() + corpus(n=40)
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = byte_bpe.op12_byte_bpe(spark, str(tmp_path)).collect()
    want = []
    for r in rows:
        text = r[1] or ""
        ids = reference.encode_ordinary(text)
        want.append(
            (
                r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_other_columns_and_empty_table(spark):
    docs = table(spark, corpus(n=4)).selectExpr("doc_id", "text", "key AS ids", "words AS IDS2", "code AS Decoded")
    out = byte_bpe.encoded_documents(docs, PATH)
    assert out.columns == ["doc_id", "text", "ids", "IDS2", "Decoded", "_ids", "_decoded"]
    assert {bytes(r["_decoded"]) for r in out.collect()} == {r["text"].encode() for r in docs.collect()}
    assert byte_bpe.encoded_documents(docs.limit(0), PATH).collect() == []
