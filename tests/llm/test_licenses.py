from __future__ import annotations

import re

from riskloom.llm import licenses
from tests.llm.cases import awkward, corpus, row, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = []
    for label, phrase in licenses.PHRASES:
        q = phrase.split()
        found += [(k, label) for k in range(len(w) - len(q) + 1) if w[k : k + len(q)] == q]
    places = [k for k, _ in found]
    return (
        len(w), len(found), min(places, default=None), max(places, default=None),
        ",".join(sorted({x for _, x in found})),
    )


def rows():
    notice = licenses.NOTICES[1][1].split()
    out = awkward() + corpus(n=20)
    out += [
        row(20, "Released under the MIT License. Under the MIT license! under the mit licenses"),
        row(21, "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0"),
        row(22, "cc by nc " * 30), row(23, "under the mit apache license version 2 cc by"),
        row(24, " ".join(notice)), row(25, " ".join(notice[:10] + ["really"] + notice[11:])),
        row(26, " ".join(notice[:8])), row(27, "under the mıt licenſe, under the MIT licenſe"),
        row(28, "under the Kit license, the GNU General Public License, version 3 applies"),
        row(20, "Released under the MIT License. Under the MIT license! under the mit licenses"),
    ]
    return out


def test_phrases_match_brute_force_and_spans_add_labels(spark):
    docs = rows()
    got = licenses.scan(table(spark, docs)).collect()
    assert len(got) == len(docs)
    mine = sorted(
        ((r.doc_id or -1), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got
    )
    want = sorted(((d[0] or -1), *plain(d[1])) for d in docs)
    assert list(map(str, mine)) == list(map(str, want))
    labels = {r.doc_id: (r.labels, r.score) for r in got}
    assert labels[24] == ("mit", 1.0)
    assert labels[25][0] == "mit" and 0.6 <= labels[25][1] < 1.0  # one word changed: spans merge
    assert labels[26] == ("", 0.0)
    assert labels[21][0] == "apache-2,cc-by-nc"
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0.0 <= r.score <= 1.0


def test_empty_table(spark):
    assert licenses.scan(table(spark, [])).collect() == []
