from __future__ import annotations

import random

import pytest

from riskloom.llm.html_text import extract, parse, render

CASES = [
    ("", ""),
    ("plain text", "plain text"),
    ("a  b\n\tc", "a b c"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<div>one<div>two</div>three</div>", "one\ntwo\nthree"),
    ("<p>x<br>y<br><br>z</p>", "x\ny\n\nz"),
    ("<b>bold</b>text <i>it</i> .", "boldtext it ."),
    ("<ul><li>a<li>b</ul>", "- a\n- b"),
    ("<ol start=9><li>a<li>b<li value=20>c</ol>", "9. a\n10. b\n20. c"),
    ("<ul><li>a<ol><li>x<li>y</ol><li>b</ul>", "- a\n  1. x\n  2. y\n- b"),
    ("<ul><li>a<br>second</ul>", "- a\n  second"),
    ("<dl><dt>term<dd>meaning<dt>next<dd>more</dl>", "term\n  meaning\nnext\n  more"),
    ("<table><tr><td>a<td>b<tr><td>long cell<td>c</table>", "a          b\nlong cell  c"),
    ("<table><tr><th>n<th align=right>v<tr><td>x<td align=right>10<tr><td>y<td align=right>5</table>",
     "n   v\nx  10\ny   5"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><tr><td colspan=2>both<tr><td>a<td>b</table>", "both\na  b"),
    ("<table><caption>C</caption><thead><tr><th>h<tbody><tr><td>d</table>", "C\nh\nd"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table>loose<tr><td>x</table>", "loose\n\nx"),
    ("<td>no table", "no table"),
    ("<pre>  keep\n   this</pre>", "  keep\n   this"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<title>t</title><style>p{}</style><script>var x='<p>no</p>'</script>yes", "yes"),
    ("a<div hidden>no</div><p style='display: none'>no</p>b", "ab"),
    ("x<span style='visibility:hidden'>n<i style='visibility:visible'>y</i>n</span>z", "xyz"),
    ("<noscript>no</noscript><template>no</template>yes<!-- no --><![CDATA[x]]>", "yes"),
    ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<select><option>a<option selected>b</select>", "b"),
    ("<textarea>a <b>x</b></textarea>", "a <b>x</b>"),
    ("&lt;tag&gt; &amp;copy; &#65; &nbsp;x", "<tag> &copy; A  x"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<p title='a > b'>q</p>", "q"),
    ("text <a href='unclosed", "text"),
    ("</p></div></nonsense>ok", "ok"),
    ("<h1>H</h1>body<hr>after", "H\n\nbody\n\nafter"),
    ("<body style='display:none'>no", ""),
    ("<p>a</p>\n\n\n<p>b</p>", "a\n\nb"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_layout(page, want):
    assert render(page) == want


def test_every_visible_word_comes_out_whatever_the_nesting():
    rng = random.Random(4)
    tags = "p div ul li ol table tr td th b i span h2 blockquote section dl dt dd a br tbody pre".split()
    for _ in range(300):
        page, words = [], []
        for k in range(rng.randrange(1, 40)):
            kind = rng.random()
            if kind < 0.4:
                page.append(f"<{rng.choice(tags)}>")
            elif kind < 0.6:
                page.append(f"</{rng.choice(tags)}>")
            else:
                words.append(f"word{k}")
                page.append(f" word{k} ")
        found = render("".join(page)).split()
        assert sorted(w for w in found if w.startswith("word")) == sorted(words), "".join(page)


def test_deep_and_long_pages():
    assert render("<div>" * 20_000 + "deep") == "deep"
    assert render("<table><tr><td>" * 300 + "deep").split() == ["deep"]
    assert render("<p>word " * 50_000).count("word") == 50_000
    assert render("<" * 50_000).count("<") == 50_000
    assert render("<a b='" * 20_000) == ""
    assert render("<li>" * 5_000 + "x").endswith("x")


def test_tree_supplies_what_is_left_out():
    root = parse("<title>t</title>text<table><td>x")
    head, body = root.children
    assert [c.tag for c in head.children] == ["title"]
    assert body.children[0] == "text" and body.children[1].children[0].tag == "tr"


def test_table_of_pages(spark):
    rows = [(1, "u", "<p>a<p>b", "x"), (2, None, None, "x"), (None, "u", "", "x"), (1, "u", "<p>a<p>b", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or -1, r.text, r.n_lines, r.n_chars) for r in extract(pages).collect())
    assert got == [(-1, "", 0, 0), (1, "a\n\nb", 3, 4), (1, "a\n\nb", 3, 4), (2, "", 0, 0)]
    assert extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a <math><mi>x</mi><mo>+</mo><mn>1</mn></math> b", "a x+1 b"),
        ("<math><semantics><mi>y</mi><annotation>latex</annotation></semantics></math>", "y"),
        ("<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>", "1 2"),
        ("<svg><defs><text>no</text></defs><path d='M0'/><text>one <tspan>two</tspan></text><g><text>three</text></g></svg>", "one two\nthree"),
        ("<svg><title>no</title><desc>no</desc></svg>after", "after"),
        ("a<xmp><b>as &amp; is</b>\n  x</xmp>b", "a\n\n<b>as &amp; is</b>\n  x\n\nb"),
        ("<select><option>a<option selected>b<option>c</select>", "b"),
        ("<select><optgroup label=g><option>a<option>b</optgroup><optgroup><option>c</select>", "a"),
        ("<select multiple><option>a<option selected>b<option>c</select>", "a\nb\nc"),
        ("<select size=3><optgroup label=Group><option>a<option>b</select>", "Group\na\nb"),
        ("<object data=x><p>instead</p></object>", "instead"),
        ("<object><div hidden>no</div><param name=q>yes</object>", "yes"),
        ("<desc>a custom tag</desc>", "a custom tag"),
    ],
)
def test_all_that_is_displayed(page, want):
    assert render(page) == want
