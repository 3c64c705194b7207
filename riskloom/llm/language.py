"""Language identification in two steps: the family first, then pairwise linear SVMs inside it.

Texts become hashed counts of letter 1- to 3-grams, as square roots of shares (unit length). Linear
one-versus-rest SVMs choose the family; inside a family a linear SVM for each pair of languages
votes. Both are fitted in numpy on a bounded sample of labelled rows; texts are scored whole, in
Arrow batches, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import (
    bounded_sample,
    fresh,
    give_back_memory,
    remainder,
    squared_hinge,
    table,
)

# Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "lb", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}

UNKNOWN = "und"
BUCKETS = 1 << 12
#: Bounds of the training sample: languages (those with most rows), rows a language, rows in all.
LANGUAGES = 300
ROWS_PER_LANGUAGE = 400
ROWS_IN_ALL = 6000

_PIECE = 1 << 18
_FOLD: list[np.ndarray] = []


def family_of(language: str) -> str:
    """The family of a code; a language outside the table is a family of its own."""
    for family, members in FAMILIES.items():
        if language in members:
            return family
    return f"only {language}"


def _fold() -> np.ndarray:
    """Code point → lower-case letter, or a blank for anything that is no letter."""
    if not _FOLD:
        out = np.full(0x110000, 32, np.uint32)
        for k in range(0x110000):
            c = chr(k)
            if c.isalpha():
                low = c.lower()
                out[k] = ord(low) if len(low) == 1 else k
        _FOLD.append(out)
    return _FOLD[0]


def letter_counts(text: str | None) -> np.ndarray | None:
    """Hashed 1-, 2- and 3-gram counts over letters and single blanks; None without any letter."""
    if not isinstance(text, str) or not text:
        return None
    fold, total = _fold(), np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    tail = np.array([32], np.uint32)
    any_letter = False
    for at in range(0, len(text), _PIECE):
        raw = text[at : at + _PIECE].encode("utf-32-le", "replace")
        letters = fold[np.frombuffer(raw, np.uint32)]
        letters = np.concatenate([tail, letters, [np.uint32(32)] if at + _PIECE >= len(text) else []])
        letters = letters.astype(np.uint32)
        blank = letters == 32
        keep = ~(blank & np.r_[False, blank[:-1]])
        any_letter |= not blank.all()
        c = letters[keep]
        one = c * np.uint32(2654435761)
        two = (c[:-1] * np.uint32(40503) + c[1:]) * np.uint32(2246822519)
        three = ((c[:-2] * np.uint32(40503) + c[1:-1]) * np.uint32(65599) + c[2:]) * np.uint32(
            3266489917
        )
        # what lies wholly in the letters carried over was counted with the piece before
        grams = np.concatenate([one[len(tail) :], two[len(tail) - 1 :], three]) >> shift
        total += np.bincount(grams, minlength=BUCKETS)
        tail = c[-2:] if len(c) > 1 else c
    return total if any_letter else None


def features(text: str | None) -> np.ndarray | None:
    counts = letter_counts(text)
    if counts is None:
        return None
    return np.sqrt(counts / counts.sum()).astype(np.float32)


@dataclass
class LanguageModel:
    """Linear weights: a column for each family, and one for each pair inside a family."""

    languages: list[str]
    families: list[str]
    weights: np.ndarray  # (BUCKETS + 1) x (families + pairs)
    pairs: list[tuple[int, int]]  # indexes into languages; the column is positive for the first

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score from 0 to 1) of each feature row."""
        margins = rows @ self.weights[:-1] + self.weights[-1]
        n = len(self.families)
        chance = 1.0 / (1.0 + np.exp(-3.0 * margins.astype(np.float64)))
        family = margins[:, :n].argmax(1)
        votes = np.zeros((len(rows), len(self.languages)))
        sure = np.zeros_like(votes)
        for k, (a, b) in enumerate(self.pairs):
            p = chance[:, n + k]
            votes[:, a] += p > 0.5
            votes[:, b] += p <= 0.5
            sure[:, a] += p
            sure[:, b] += 1.0 - p
        member = np.array([[family_of(x) == f for x in self.languages] for f in self.families])
        inside = member[family]
        opponents = np.maximum(inside.sum(1) - 1, 1)
        # most votes, then the surer sum, then the first language in order
        merit = np.where(inside, votes + sure / (2.0 * len(self.languages)), -1.0)
        best = merit.argmax(1)
        pairwise = np.where(
            inside.sum(1) > 1, sure[np.arange(len(rows)), best] / opponents, 1.0
        )
        family_sure = chance[np.arange(len(rows)), family] if n > 1 else 1.0
        return best, np.clip(pairwise * family_sure, 0.0, 1.0)


def fit(docs: DataFrame, penalty: float = 1e-5) -> LanguageModel:
    """Fit on a bounded sample of rows with text and lang whose id hash leaves a remainder but 0."""
    labelled = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), 5) != 0)
    ).select("doc_id", "text", "lang")
    most = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    known = [r.lang for r in most.collect()]
    labelled = labelled.where(F.col("lang").isin(known))
    share = max(1, min(ROWS_PER_LANGUAGE, ROWS_IN_ALL // max(1, len(known))))

    @pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = [features(t) for t in batch]
            yield pd.Series([None if r is None else r.astype("<f2").tobytes() for r in rows])

    rows = (
        bounded_sample(
            labelled, "lang", [F.col("doc_id"), F.lit("lang")], share, "doc_id", "lang", "text"
        )
        .select("doc_id", "lang", packed("text").alias("x"))
        .where(F.col("x").isNotNull())
        .toPandas()
        .sort_values(["doc_id", "lang"], kind="stable")
    )
    languages = sorted(rows.lang.unique())
    families = sorted({family_of(x) for x in languages})
    pairs = [
        (a, b)
        for a, b in combinations(range(len(languages)), 2)
        if family_of(languages[a]) == family_of(languages[b])
    ]
    if not languages:
        return LanguageModel([], [], np.zeros((BUCKETS + 1, 0), np.float32), [])
    x = np.stack([np.frombuffer(b, "<f2") for b in rows.x]).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    lang = rows.lang.map(languages.index).to_numpy()
    fam = np.array([families.index(family_of(languages[k])) for k in lang])
    y = np.zeros((len(x), len(families) + len(pairs)), np.float32)
    weight = np.ones_like(y)
    balance = 1.0 / np.bincount(fam, minlength=len(families))
    for k in range(len(families)):
        y[:, k] = np.where(fam == k, 1, -1)
        weight[:, k] = np.where(fam == k, balance[k], 1.0 / max(1, (fam != k).sum()))
    for k, (a, b) in enumerate(pairs, len(families)):
        y[:, k] = (lang == a).astype(int) - (lang == b)
        weight[:, k] = np.where(lang == a, 1.0 / (lang == a).sum(), 1.0 / (lang == b).sum())
    return LanguageModel(languages, families, squared_hinge(x, y, weight, penalty), pairs)


def predicted(text: Column, model: LanguageModel) -> Column:
    """Struct ``lang_pred, score`` of a text column."""

    @pandas_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang = np.full(len(batch), UNKNOWN, object)
            score = np.zeros(len(batch))
            for at in range(0, len(batch), 256):
                rows = [features(t) for t in batch.iloc[at : at + 256]]
                have = [k for k, r in enumerate(rows) if r is not None]
                if have and model.languages:
                    best, sure = model.predict(np.stack([rows[k] for k in have]))
                    lang[at + np.array(have)] = np.array(model.languages, object)[best]
                    score[at + np.array(have)] = sure
            yield pd.DataFrame({"lang_pred": lang, "score": score})
        give_back_memory()

    return predict(text)


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    ``und`` with score 0 stands for a null text, a text without letters, or a table without labelled
    rows. Repeated rows are kept; a null id counts as empty text for ``held_out``; columns other than
    ``doc_id``, ``text`` and (to learn) ``lang`` are not read. The sample's bounds are
    ``LANGUAGES``, ``ROWS_PER_LANGUAGE`` and ``ROWS_IN_ALL``; a language beyond the first is not learned.
    """
    model = model or fit(docs)
    found = docs.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        predicted(F.col("text"), model).alias("p"),
    )
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def in_languages(
    docs: DataFrame, wanted: list[str] | None = None, least: float = 0.0
) -> DataFrame:
    """Rows of ``docs`` whose text is in a wanted language (default: any learned), columns kept.

    Rows predicted ``und`` go, as do rows with a score under ``least``.
    """
    (mark,) = fresh(docs, "found")
    found = docs.withColumn(mark, predicted(F.col("text"), fit(docs)))
    keep = (F.col(f"{mark}.lang_pred") != UNKNOWN) & (F.col(f"{mark}.score") >= least)
    if wanted is not None:
        keep &= F.col(f"{mark}.lang_pred").isin(wanted)
    return found.where(keep).drop(mark)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
