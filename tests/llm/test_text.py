import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gridagro.llm import text as T

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def texts(seed):
    rnd = random.Random(seed)
    alphabet = ["a", "B", "é", "ß", "9", " ", "\n", "\t", ".", "-", "漢", "😀", "\x00", "\x1f", "\xa0", "Z"]
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(50)]
    long = " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9))) for _ in range(150_000))
    return [*out, None, "", long, "y" * 700_000, "z " + "w" * 600_000 + " v", "tail"]


@pytest.mark.parametrize("kind, pattern", [(T.SPACED, SPACES), (T.ALPHANUMERIC, LETTERS)])
def test_words_are_those_of_the_pattern(kind, pattern):
    given = texts(1)
    words = T.Words(pa.array(given), kind, lower=True, places=True)
    known = {}
    for i, s in enumerate(given):
        want = pattern.findall(lower(s or ""))
        got = words.hashes[words.bounds[i] : words.bounds[i + 1]].tolist()
        assert len(want) == len(got)
        for w, h in zip(want, got, strict=True):
            assert known.setdefault(w, h) == h
        ends = zip(words.starts[words.bounds[i] : words.bounds[i + 1]], words.ends[words.bounds[i] : words.bounds[i + 1]], strict=True)
        assert [lower(bytes(words.data[a:b]).decode()) for a, b in ends] == want
    assert len(set(known.values())) == len(known)


def test_a_slice_of_a_column_has_the_same_words():
    column = pa.array(["no", "one two", None, "two one"])
    words, part = T.Words(column), T.Words(column.slice(1, 3))
    assert part.bounds.tolist() == [0, 2, 2, 4]
    assert part.hashes.tolist() == words.hashes[1:].tolist()


@pytest.mark.parametrize("n", [1, 2, 5, 6, 13])
def test_windows(n):
    given = ["a b c d e f g h i j k l m n o", "a b", "", "b c d e f g h i j k l m n o p"]
    words = T.Words(pa.array(given))
    hashes, fits = T.windows(words, n)
    seen = {}
    for i, s in enumerate(given):
        w = s.split()
        for k in range(len(w)):
            at = words.bounds[i] + k
            assert fits[at] == (k + n <= len(w))
            if fits[at]:
                assert seen.setdefault(tuple(w[k : k + n]), hashes[at]) == hashes[at]
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("width", [1, 2, 6, 8])
def test_sliding_least(width):
    values = np.random.default_rng(0).integers(0, 9, 200).astype(np.uint64)
    got = T.sliding_least(values, width)
    for i in range(200 - width + 1):
        assert got[i] == i + int(np.argmin(values[i : i + width]))


def test_slices_keep_all_rows():
    batch = pa.record_batch([pa.array(range(7)), pa.array(["a" * 10, None, "b" * 50, "", "c" * 5, "d" * 5, "e" * 100])], ["i", "t"])
    parts = list(T.slices(batch, 1, 20))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(7))
    assert len(parts) > 2
    assert sum(len(p) for p in T.slices(batch.slice(0, 0), 1)) == 0


def test_words_and_links_of_neighbours_decide_without_marks():
    """Pages that the tree was not grown from, in plain elements: all their blocks are judged right."""
    from gridagro.llm import html_text

    tree = html_text.trained_tree()
    assert {"words", "links", "links after"} <= {html_text.FEATURES[k] for k in _splits(tree)}
    a = "Wind and rain kept the boats in harbour for the whole of the week, said the harbour master on Friday."
    b = "The catch will be small this year, and prices in the market have gone up by a quarter already since May."
    c = "Two of the oldest boats were lifted out of the water and laid on the grass behind the chapel until the spring."
    pages = (
        (f"<div><a href=/>Start</a> <a href=/w>Weather</a></div><h1>Storm over the coast</h1><p>{a}</p><p>{b}</p><div>Copyright 2023 Coast Radio. All rights reserved.</div>", f"Storm over the coast\n{a}\n{b}"),
        (f"<table><tr><td><a href=/>Start</a></td><td><a href=/s>Search</a></td></tr></table><div><h2>Boats</h2><p>{c}</p><p>No one objected.</p><p>{a}</p></div><div><a href=/x>About this station</a></div>", f"Boats\n{c}\nNo one objected.\n{a}"),
        (f"<div>Coast Radio</div><div><a href=/a>Live</a></div><div><a href=/b>Archive</a></div><div>{a}</div><div>{b}</div><div>{c}</div><div>© 2024 Coast Radio</div>", f"{a}\n{b}\n{c}"),
        (f"<div><p>{a}</p><ul><li>Nets and lines</li><li>A winch</li></ul><p>{b}</p></div><ul><li><a href=/1>More on fishing</a></li><li><a href=/2>Harbour prices in May</a></li></ul>", f"{a}\nNets and lines\nA winch\n{b}"),
        (f"<div><h1>Harbour</h1><p>{b} See <a href=/t>the table</a>.</p><h3>Outlook</h3><p>{c}</p></div><div><a href=/t>Terms</a> and <a href=/p>privacy</a></div>", f"Harbour\n{b} See the table.\nOutlook\n{c}"),
    )
    for page, want in pages:
        assert html_text.main_text(page, tree) == want


def _splits(tree):
    return set() if isinstance(tree, float) else {tree[0]} | _splits(tree[2]) | _splits(tree[3])


def test_marks_quotes_and_headers_of_articles():
    from gridagro.llm import html_text

    tree = html_text.trained_tree()
    pages = {
        "<article><header><h1>A headline</h1></header><p>Words of it.</p></article>": "A headline\nWords of it.",
        "<header><p>The Paper</p></header><article><p>Words of it.</p></article>": "Words of it.",
        "<article><p class=x' id=a>One of two.</p><p>It's the other.</p></article>": "One of two.\nIt's the other.",
        "<article><p title=\"a > b\" id='c > d'>Whole tag.</p></article>": "Whole tag.",
        "<article><p>Words.</p><div class='cookie-banner-wrapper'>Cookies</div><div id=ad-slot-1>Buy</div><div class=adsbygoogle>Buy</div><div class=advertBox>Buy</div><p>End.</p></article>": "Words.\nEnd.",
        "<article><div class='no-comments with-sidebar'><p>Words stay.</p></div></article>": "Words stay.",
    }
    for page, want in pages.items():
        assert html_text.main_text(page, tree) == want, page


def test_tree_separates_its_layouts():
    from gridagro.llm import html_text

    tree = html_text.trained_tree()
    for page, main in html_text.layouts():
        assert html_text.main_text(page, tree) == "\n".join(main)
