"""Operators that look at one text at a time."""

import random
import re
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from odd_texts import odd_texts
from tokenizers import Tokenizer

from tabweave.llm import html_text, quality_rules, token_counts
from tabweave.llm.arrays import Texts

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    w = SPACE.findall(text)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i : i + 3]), []).append(i)
    repeat = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if SPACE.search(line):
            dup += line in lines
            lines.add(line)
    limits = quality_rules.Limits()
    cover, longest = set(), 0
    for i in range(len(w)):
        for j in range(i):
            n = 0
            while i + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            if n >= limits.min_repeat:
                longest = max(longest, n)
                cover |= {*range(i, i + n), *range(j, j + n)}
    failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
    kept = not (failed or 100 * len(cover) > limits.max_covered_percent * len(w) or longest > limits.max_longest)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat), len(cover), longest, failed, kept


def test_measures_against_plain_counts(spark):
    rng = random.Random(1)
    texts = [t for t in odd_texts() if t is None or len(t) < 2000]
    for _ in range(60):
        w = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(120))]
        part = [f"p{i}" for i in range(rng.randrange(70))]
        texts.append(" ".join(w[:60] + part + w[60:] + part) + "\n" + " ".join(part))
        texts.append("\n".join(rng.choice(["a b", "a b ", "", " ", "c #*$ é", "|<>&%"]) for _ in range(20)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in quality_rules.score(df).collect()}
    assert got == {i: plain_measures(t) for i, t in enumerate(texts)}
    kept = sorted(r.doc_id for r in quality_rules.keep_good(df).collect())
    assert kept == [i for i, t in enumerate(texts) if plain_measures(t)[-1]]


def test_quality_of_odd_rows(odd, odd_rows, no_docs):
    assert quality_rules.score(odd).count() == len(odd_rows)
    assert quality_rules.keep_good(odd).columns == odd.columns
    assert quality_rules.score(no_docs).count() == 0 == quality_rules.keep_good(no_docs).count()


def test_suffix_array_of_words_is_sorted():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, 200).astype(np.uint64)
    bounds = np.array([0, 0, 70, 71, 200])
    order, levels = quality_rules.rank_levels(words, bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = [int(i) for i in order if a <= i < b]
        # Longer after shorter: a suffix that ends is less than its extensions.
        assert own == sorted(range(a, b), key=lambda i: words[i:b].tolist())
    assert quality_rules.repetition(np.zeros(0, np.uint64), np.array([0, 0]), 5)[0].tolist() == [0]


def test_counts_are_the_tokenizers(spark, odd, no_docs):
    texts = odd_texts() + ["<|endoftext|> a<|endoftext|>", "it's I'll we've  \n\n x\t\ty ", "日本語 текст עברית العربية 🙂", "a\u0085b\x1cc d\xa0e", "x" * 5000, "12 345 ½²³ ___ a_b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    library = Tokenizer.from_file(VOCABULARY)
    for frequent in (5, 1000):
        got = {r.doc_id: r for r in token_counts.count_tokens(df, VOCABULARY, frequent=frequent).collect()}
        for i, t in enumerate(texts):
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512), t
    assert token_counts.count_tokens(odd, VOCABULARY).count() == odd.count() and token_counts.count_tokens(no_docs, VOCABULARY).count() == 0


def test_safe_characters_are_split_alike():
    library = Tokenizer.from_file(VOCABULARY)
    find, doubtful = re.compile(token_counts.PRE_TOKEN).findall, re.compile(token_counts.DOUBTFUL).search
    safe = [chr(c) for c in range(0x3000) if not doubtful(chr(c)) and unicodedata.category(chr(c)) != "Cs"]
    assert len(safe) > 500
    for c in safe:
        for text in (f"a{c}b", f" {c}{c} {c}1", f"1{c}'s {c}", f"!{c}  {c}\n{c}"):
            want = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert find(text) == want, (c, text)


PAGES = {
    "<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1>"
    "<p>One,  two\n three.<br>four</p><p>Five <b>six</b>seven</p><aside>see also</aside><ul><li>x</li><li>y</ul></article>"
    "<div class='comments'><p>Nice, really, very, nice article, thanks a lot for it all.</p></div><footer>&copy; me</footer>": "A & B\nOne, two three. four\nFive sixseven\nx\ny",
    "<body><div id=menu>Menu</div><div class='page has-sidebar'><div class=content><p>Long text, with commas, and more commas, that goes on.</p>"
    "<p>Short.</p></div><div class=sidebar><p>Other, things, to, read, here, now.</p></div></div><div class='cookie-notice'>We use cookies, many.</div>": "Long text, with commas, and more commas, that goes on.\nShort.",
    "<article><p>A<script>var x = '<p>no</p>';</script>B</p><!-- <p>gone</p> --><form><input value=1>Send</form><p hidden>h</p><p style='display: none'>n</p></article>": "AB",
    "<article><p>unclosed <b>bold<br><p>next &lt;tag&gt; &#233;&nbsp;&unknown; 1 < 2": "unclosed bold\nnext <tag> é &unknown; 1 < 2",
    "<header><p>Site</p></header><main><header><h1>Title</h1></header><p>Body text.</p></main>": "Body text.",
    "<p title='a > b'>quoted</p>": "quoted",
    "just text": "just text",
    "<div><a href=1>only</a> <a href=2>links</a></div>": "only links",
    "<nav>menu</nav>": "",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "<p>cut <a href='": "cut",
}


BODY = "<p>A first paragraph, with commas, and more, that goes on.</p><p>A second paragraph, with commas.</p>"
TEXT = "A first paragraph, with commas, and more, that goes on.\nA second paragraph, with commas."
WRAPPED = {
    f"<div class='content-sidebar-wrap'><main>{BODY}</main><div class=sidebar><p>Other, things.</p></div></div>": TEXT,
    f"<div class='layout sidebar-right'><div><div class=content>{BODY}</div></div></div><div class=promo>Buy, now.</div>": TEXT,
    f"<div id='page' class='site cookies-not-set'><article>{BODY}</article><div class=related><article><p>A card, short.</p></article></div></div>": TEXT,
    f"<div class=content>{BODY}</div><div class=comments>{BODY * 5}</div>": TEXT,
    f"<article>{BODY}</article><div id=comments><article class=comment>{BODY * 5}</article></div>": TEXT,
    "<div class='cookie-notice'>We use cookies.</div>": "We use cookies.",
    f"<article>{'<div>' * 40}<header><h1>Title</h1></header>{BODY}": f"Title\n{TEXT}",
    f"<article><ul><li>a{'<i>' * 300}b<li>c</ul></article>": "ab\nc",
}


@pytest.mark.parametrize("html", WRAPPED)
def test_layout_words_do_not_hide_the_article(html):
    assert html_text.main_text(html) == WRAPPED[html]


@pytest.mark.parametrize("html", PAGES)
def test_main_text(html):
    assert html_text.main_text(html) == PAGES[html]


def test_pages_frame(spark):
    rows = [(1, "u", "<article><p>é x</p></article>", "e"), (2, None, None, None), (3, "v", "", "t"), (1, "u", "<article><p>é x</p></article>", "e")]
    rows.append((4, "w", "<div>" * 3000 + "deep " * 20000 + "</div>" * 3000, "n"))
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id, r.text[:5], r.n_chars) for r in got) == [(1, "é x", 3), (1, "é x", 3), (2, "", 0), (3, "", 0), (4, "deep ", 99999)]
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_empty_chunk():
    t = Texts(0, np.zeros(0, np.uint8), np.zeros(2, np.int64))
    assert quality_rules.measures(t, quality_rules.Limits())["n_words"].tolist() == [0]
