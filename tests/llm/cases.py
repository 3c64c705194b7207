"""Small tables for the corpus tests, with the awkward cases every operator must take."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, key string, "
    "words string, code long"
)

COMMON = {
    "en": "the of and to in is that it was for on are with as they be at this have from".split(),
    "de": "der die und das den von ist nicht mit ein eine im zu auf sich für dem auch".split(),
    "fr": "le la les et des du un une est dans que qui pour pas sur avec plus par".split(),
    "es": "el los las y que en una por con para del se al es lo no su más".split(),
}
SYLLABLES = {
    "en": "ing ther ound ness ight wh ea ly ou sh".split(),
    "de": "ung keit sch pf heit chen ö ä ß lich".split(),
    "fr": "tion eau eux ê ç oi ment è aux que".split(),
    "es": "ción ñ dad ado rr ll ó í mente cio".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    words = []
    for _ in range(n):
        if rng.random() < 0.4:
            words.append(rng.choice(COMMON[lang]))
        else:
            words.append("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(2, 4))))
        if rng.random() < 0.1:
            words[-1] += "."
    text = " ".join(words)
    return text[:1].upper() + text[1:]


def row(doc_id, text, lang="en", source="s0"):
    """Columns with names that operators use inside come along."""
    n = None if text is None else len(text)
    return (doc_id, text, lang, source, n, 0.5, "k", "w", 7)


def awkward() -> list[tuple]:
    """Nulls, empty and long texts, repeated rows, odd characters."""
    rng = random.Random(3)
    long = prose(rng, "en", 30_000)
    return [
        row(1, None), row(2, ""), row(3, "   \n\t"), row(4, "one"), row(None, "text without id here"),
        row(5, None, None, None), row(6, "!!! ### 123 ???"), row(7, long), row(8, long),
        row(9, "same row twice in the table"), row(9, "same row twice in the table"),
        row(10, "ÀÉ ß ἀρχή 漢字 ́ İstanbul \x1c tab\tand\x0bvertical"),
        row(11, "a " * 400), row(12, "under the MIT license, cc by nc"), row(13, "x" * 5000),
    ]


def corpus(seed: int = 1, n: int = 160) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = ["en", "de", "fr", "es"][i % 4]
        out.append(row(1000 + i, prose(rng, lang, rng.randrange(20, 120)), lang, f"s{i % 3}"))
    return out


def table(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)
