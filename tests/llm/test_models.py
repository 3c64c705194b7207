"""Trained operators: held-out accuracy on small made texts, and every awkward row answered."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import class_lm, cotraining, language, toxicity
from tests.llm.cases import SCHEMA, awkward, corpus, prose, row, table

INSULTS = ["zorgle", "blaffen", "quimby"]


def remainder(doc_id, m):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % m


@pytest.fixture(scope="module")
def docs():
    return awkward() + corpus(n=400)


# --- language ---------------------------------------------------------------------------------


def test_held_out_languages(spark, docs):
    got = language.identify(table(spark, docs)).collect()
    assert len(got) == len(docs)
    by_id = {r.doc_id: r for r in got}
    held = [d for d in docs if (d[0] or 0) >= 1000 and remainder(d[0], 5) == 0]
    right = sum(by_id[d[0]].lang_pred == d[2] for d in held)
    assert len(held) > 40 and right >= 0.97 * len(held)
    for d in docs:
        r = by_id[d[0]]
        assert r.held_out == (remainder(d[0], 5) == 0)
        assert 0.0 <= r.score <= 1.0
        if not any(c.isalpha() for c in d[1] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in {"en", "de", "fr", "es"}


def test_language_filter_keeps_columns(spark, docs):
    df = table(spark, docs)
    kept = language.in_languages(df)
    assert kept.columns == df.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert not {1, 2, 3, 5, 6} & ids.keys() and ids[9] == 2 and ids[1003] == 1
    only = {r.lang for r in language.in_languages(df, ["fr"]).where("doc_id >= 1000").collect()}
    assert "fr" in only and len(only) <= 2


def test_language_of_long_texts_uses_every_piece(monkeypatch):
    rng = random.Random(1)
    text = prose(rng, "fr", 300)
    whole = language.letter_counts(text)
    for piece in (7, 64, 501):
        monkeypatch.setattr(language, "_PIECE", piece)
        assert (language.letter_counts(text) == whole).all()


def test_language_without_labels(spark):
    rows = [row(1, "some text", None), row(2, None, None)]
    assert {r.lang_pred for r in language.identify(table(spark, rows)).collect()} == {"und"}
    assert language.identify(table(spark, [])).collect() == []


# --- toxicity ---------------------------------------------------------------------------------


def toxic_docs():
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(700):
        words = prose(rng, ["en", "de"][i % 2], rng.randrange(10, 60)).split()
        bad = int(i % 3 == 0)
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "ung", "!!"]))
        docs.append(row(2000 + i, " ".join(words)))
        labels.append((2000 + i, bad, bad))
    return docs, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_toxicity(spark):
    docs, marks = toxic_docs()
    extra = [(None, 0, 1), (2000, None, None), (7, 0, 0), (7, 0, 1), (999_999, 1, 1)]
    rows = docs + awkward()
    got = toxicity.score_documents(table(spark, rows), labels_of(spark, marks + extra)).collect()
    assert len(got) == len(rows)
    truth = dict((k, t) for k, _, t in marks)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.5) for r in got)
    empty = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1 and max(empty) < 0.5


def test_toxic_words_at_the_end_of_a_long_text_count(spark, monkeypatch):
    docs, marks = toxic_docs()
    model = toxicity.fit(table(spark, docs), labels_of(spark, marks))
    clean = " ".join(d[1] for d, m in zip(docs, marks) if not m[2])
    texts = [clean, clean + " " + INSULTS[0], INSULTS[0] + " " + clean]
    plain, _ = toxicity._logits(model, model.tables(), texts)
    monkeypatch.setattr(toxicity, "_PIECE", 97)
    pieces, _ = toxicity._logits(model, model.tables(), texts)
    assert np.allclose(plain, pieces, atol=1e-4)
    assert plain[1] > plain[0] and plain[2] > plain[0]


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Shards hold all rows that may be learned from, and averaged shards still know the insults."""
    seen = []
    sharded = toxicity._sharded
    monkeypatch.setattr(toxicity, "_sharded", lambda rows, n: seen.append((sharded(rows, n), n)) or seen[-1][0])
    rows, marks = toxic_docs()
    model = toxicity.fit(table(spark, rows), labels_of(spark, marks), shard_rows=60)
    (shards, n), learned = seen[0], [m for m in marks if remainder(m[0], 5) > 1]
    assert n == math.ceil(len(learned) / 60) > 2
    assert sum(len(s.toxic) for s in shards.collect()) == len(learned)
    scored = toxicity.score_documents(table(spark, rows), labels_of(spark, marks), model).collect()
    truth = {k: t for k, _, t in marks}
    held = [r for r in scored if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_toxicity_filter_and_missing_labels(spark):
    docs, marks = toxic_docs()
    df = table(spark, docs)
    kept = toxicity.without_toxic(df, labels_of(spark, marks))
    assert kept.columns == df.columns
    truth = dict((k, t) for k, _, t in marks)
    ids = [r.doc_id for r in kept.collect()]
    clean = [k for k, t in truth.items() if not t]
    assert len(set(ids) & set(clean)) >= 0.97 * len(clean)
    none = toxicity.score_documents(table(spark, awkward()), labels_of(spark, [])).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.score_documents(table(spark, []), labels_of(spark, [])).collect() == []


# --- class language model ---------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_base_counts_match_brute_force_and_the_model_beats_it(spark, docs, monkeypatch):
    monkeypatch.setattr(class_lm, "ITEMS", 100)
    monkeypatch.setattr(class_lm, "LOOKUP", 150)  # so that joined words are many
    got = class_lm.score_documents(table(spark, docs), rounds=3).collect()
    assert len(got) == len(docs)
    words = [re.findall(r"[^\x20\x09-\x0D]+", (d[1] or "").translate(LOWER)) + [None] for d in docs]
    counts = Counter(w for d, ws in zip(docs, words) if remainder(d[0], 7) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for d, ws in zip(docs, words):
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        want[d[0], remainder(d[0], 7) == 2, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 4)] += 1
    mine = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got
    )
    assert mine == want
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score <= 0.0 for r in got)


def test_probabilities_sum_to_one(spark, docs):
    training = table(spark, docs).select("doc_id", "text")
    words = class_lm.vocabulary(training)
    m = class_lm.fit(training, words, rounds=2)
    assert np.allclose((10.0**m.step).sum(1), 1.0)
    assert np.allclose(np.bincount(m.classes, 10.0**m.item, class_lm.CLASSES)[np.unique(m.classes)], 1.0)
    head = set(m.head)
    tail = [(bytes(r.word), r.unit, r.n) for r in words.collect() if bytes(r.word) not in head]
    inside = 10.0 ** m.unseen()
    for _, u, n in tail:
        inside[u] += (n - m.discount) / m.unit_tokens[u]
    assert np.allclose(inside, 1.0)


def test_every_word_up_to_the_bound_is_an_item_of_its_own(spark):
    rows = [(k, " ".join(f"w{j}" for j in range(k, 6000, 20))) for k in range(20)]
    training = spark.createDataFrame(rows, "doc_id long, text string")
    words = class_lm.vocabulary(training)
    m = class_lm.fit(training, words, rounds=1)
    assert len(m.head) == 6001 and not m.unit_tokens.any()
    # counts that are equal do not shorten the list
    assert len(class_lm.most_frequent(words, 500)) > 450
    twice = spark.createDataFrame([(1, "a a a b b b c c " + rows[0][1])], "doc_id long, text string")
    top = class_lm.most_frequent(class_lm.vocabulary(twice), 3)
    assert [(w, n) for w, _, n in top] == [(b"a", 3), (b"b", 3), (b"c", 2)]


def test_exchange_raises_the_likelihood(spark):
    rows = [(1, "a x b y a x b y a y b x " * 40), (2, "c z c z c z " * 40)]
    training = spark.createDataFrame(rows, "doc_id long, text string")
    m = class_lm.fit(training, class_lm.vocabulary(training), rounds=4)
    assert max(m.bigram_likelihood) >= m.bigram_likelihood[0]
    left, right = class_lm._neighbours(class_lm.item_sequences(training, m.head), m.classes)
    moved = class_lm.exchange(m.classes, left, right, np.arange(1, len(m.head)))
    again = class_lm._neighbours(class_lm.item_sequences(training, m.head), moved)[1]
    assert class_lm._likelihood(class_lm._by_class(again, moved)) >= m.bigram_likelihood[0] - 1e-6


def test_language_model_on_tables_without_training(spark):
    assert class_lm.score_documents(table(spark, []), rounds=1).collect() == []
    only = next(k for k in range(100) if remainder(k, 7) == 2)
    (r,) = class_lm.score_documents(table(spark, [row(only, "held out only")]), rounds=1).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (4, 0, 0, 0.0)


# --- co-training ------------------------------------------------------------------------------


def quality_docs():
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(500):
        text, good = prose(rng, ["en", "fr"][i % 2], rng.randrange(20, 80)), int(i % 4 != 0)
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), " | ".join(text.split()), "ab " * 60])
        docs.append(row(3000 + i, text, "en", f"s{i % 5}" if good else f"bad{i % 2}"))
        if i % 3:
            labels.append((3000 + i, good, 0))
    return docs, labels


def test_quality_of_rows_without_labels(spark):
    docs, labels = quality_docs()
    extra = [(3001, 0, 0), (None, 1, 1), (3000, None, 1)]
    rows = docs + awkward()
    got = cotraining.score_documents(table(spark, rows), labels_of(spark, labels + extra)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    unseen = [(3000 + i, int(i % 4 != 0)) for i in range(500) if i % 3 == 0]
    right = sum(by_id[k].kept == bool(good) for k, good in unseen)
    assert right >= 0.95 * len(unseen)
    for r in got:
        assert 0.0 <= min(r.score, r.content_score, r.metadata_score) and r.score <= 1.0


def test_views_pass_labels_to_each_other():
    rng = np.random.default_rng(3)
    y = (rng.random(300) < 0.5).astype(float)
    one = np.ones((300, 1))
    a = np.c_[y[:, None] * 4 - 2 + rng.normal(0, 0.5, (300, 3)), one]
    b = np.c_[y[:, None] * 4 - 2 + rng.normal(0, 0.5, (300, 2)), one]
    few = np.arange(300) < 40
    aside = np.arange(40) % 5 == 0
    model = cotraining.cotrain(a[few], b[few], y[few], aside, a[~few], b[~few])
    assert model.exchanged[0] > 0
    za, zb = model.views(a[~few], b[~few])
    z = model.combine[0] * za + model.combine[1] * zb + model.combine[2]
    assert ((z > 0) == (y[~few] > 0)).mean() > 0.97


def test_quality_without_labels(spark):
    none = cotraining.score_documents(table(spark, awkward()), labels_of(spark, [])).collect()
    assert {(r.score, r.kept) for r in none} == {(0.5, True)}
    assert cotraining.score_documents(table(spark, []), labels_of(spark, [])).collect() == []
    assert SCHEMA


def test_shards_are_compressed_until_a_task_trains_on_them(spark):
    text = "some words that a long text repeats " * 500
    rows = spark.createDataFrame([(k, 1, *toxicity._packed(text)) for k in range(20)], "doc_id long, toxic int, x binary, size long")
    shards = toxicity._sharded(rows, 2).collect()
    assert sum(len(s.x) for s in shards) == 20 and sum(len(b) for s in shards for b in s.x) < rows.first().size
    plain = [toxicity.word_buckets(w) for w in toxicity.split_words(text)]
    assert all(toxicity._unpacked(b).tolist() == [list(w) for w in plain] for s in shards for b in s.x)
    assert toxicity._unpacked(toxicity._packed(None)[0]).shape == (0, 3)
