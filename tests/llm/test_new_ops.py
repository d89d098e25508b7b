"""HTML extraction, hard negatives and the prefix trie: whole results against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity.llm.main_text import extract_main_text, main_text
from veracity.llm.negatives import mine_hard_negatives, packed_scores, whole_vectors
from veracity.llm.prefix_trie import fattest, prefix_trie, turn_sequences
from veracity.llm.queries import rebuilt

PAGE = """<!doctype html><html><head><title>T</title><script>var s = "</p>";</script></head>
<body class="page-with-sidebar"><div id="wrap-sidebar"><nav><a href="/">Home</a></nav>
<div class="cookie-notice">We use cookies, yes.</div>
<article class="post comments-open"><header><h1>Title &amp; more</h1></header>
<p>First, para <span class="ad">buy <span>x</span> now</span>with <a href="x">link</a> text.<p>Second<br>line &nbsp; 3 &lt;b&gt;
<ul><li>one<li>two</ul><pre>a
 b</pre><form><p>Name, a, b, c, d</p><input></form><p hidden>secret, a, b</p>
<section class="comments"><article class="comment"><p>Nice, great, super, that is, long.</p></article></section></article>
<aside><p>side, bar, a, b, c</p></aside></div><footer>f</footer><script>if (a < b) document.write("<p>x, y</p>")"""


def test_main_text_pages():
    assert main_text(PAGE) == "Title & more\nFirst, para with link text.\nSecond line 3 <b>\none\ntwo\na b"
    assert main_text("") == "" and main_text("plain <b>text</b> only") == "plain text only"
    assert main_text("<p>a<!-- x") == "a" and main_text('a <a href="') == "a" and main_text("<p>a</p><sc") == "a"
    two = main_text("<div><div><p>" + "long, text. " * 30 + "</p></div><div><p>short.</p></div></div>")
    assert two.endswith("\nshort.")
    links = "".join(f'<li><a href="/{k}">entry {k}, with, commas</a></li>' for k in range(40))
    assert "entry" not in main_text(f"<div><ul>{links}</ul><div><p>{'A real, long sentence. ' * 9}</p></div></div>")
    deep = main_text("<div>" * 3000 + "<p>deep, text</p>")
    assert deep == "deep, text"
    long = "word, " * 200_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()


def test_main_text_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", "y"), (3, "w", "<p>a</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(df, keep=("page_id", "url", "text"), text_col="main").collect()
    assert len(got) == 5 and sorted(r.main for r in got) == sorted([main_text(PAGE)] * 2 + ["", "", "a"])
    assert extract_main_text(df.where("page_id > 9")).count() == 0


@pytest.mark.parametrize("lo,hi", [(-256, 256), (0, 1), (-5, 5), (-2**20, 2**20), (-2**27, 2**27), (3, 9), (-9, -3), (0, 0)])
def test_packed_scores(lo, hi):
    rng = np.random.default_rng(3)
    a, r = rng.integers(lo, hi + 1, (7, 33)), rng.integers(lo, hi + 1, (21, 33))
    assert (packed_scores(a, r) == (a.astype(object) @ r.T.astype(object))).all()
    assert packed_scores(a[:0], r).shape == (0, 21) and packed_scores(a, r[:0]).shape == (7, 0)


def brute_negatives(rows, anchor):
    """(id, label, whole vector) rows -> the set of results, for unique ids."""
    out = []
    for a, la, va in rows:
        if not anchor(a):
            continue
        score = {v: sum(x * y for x, y in zip(va, vec)) for v, _, vec in rows if v != a}
        label = {v: lv for v, lv, _ in rows}
        best = sorted((v for v in score if label[v] == la), key=lambda v: (-score[v], v))[:5]
        for p in best:
            fits = [v for v in score if label[v] != la and 80 * score[p] <= 100 * score[v] <= 100 * score[p]]
            for k, v in enumerate(sorted(fits, key=lambda v: (-score[v], v))[:5]):
                out.append((a, p, k + 1, v, score[p], score[v]))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [16 << 20, 400])
def test_hard_negatives(spark, block_bytes):
    rng = random.Random(2)
    base = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(40)]
    rows = []
    for k in range(300):
        vec = list(rng.choice(base)) if k % 3 else [rng.uniform(-1, 1) for _ in range(6)]
        rows.append((k * 5, 7 if k % 3 == 0 else rng.randrange(3), vec, "x"))   # a hot label, many equal vectors
    whole = [(v, y, [int(np.floor(256 * x)) for x in vec]) for v, y, vec, _ in rows]
    bad = [(2000, None, base[0], "x"), (2100, 1, None, "x"), (2200, 1, [1.0, None] + base[0][2:], "x"),
           (2300, 1, [float("nan")] + base[0][1:], "x"), (2400, 1, [float("-inf")] + base[0][1:], "x"), (None, 1, base[0], "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, label int, embedding array<double>, score string").repartition(4)
    vectors = whole_vectors(df, "vec_id", F.col("label"), "embedding", 256.0)
    got = mine_hard_negatives(vectors, vectors.where("id % 100 = 0"), block_bytes=block_bytes)
    want = brute_negatives(whole, lambda v: v % 100 == 0)
    assert want and sorted(map(tuple, got.collect())) == want
    assert mine_hard_negatives(vectors.where("id < 0"), vectors.where("id < 0")).count() == 0


def test_hard_negatives_odd_vectors(spark):
    rows = [(0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (1, 1, [1.0]), (2, 1, []), (3, 2, [1.0, 0.0, 5.0]), (3, 2, [1.0, 0.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    vectors = whole_vectors(df, "vec_id", F.col("label"), "embedding", 1.0)
    got = sorted(map(tuple, mine_hard_negatives(vectors, vectors.where("id = 0")).collect()))
    # The rows of id 0 are one anchor, never their own positive; a row that repeats is listed twice.
    assert got == [(0, 1, 1, 3, 1, 1), (0, 1, 2, 3, 1, 1)]


def test_fattest(spark):
    pairs = [(lo, hi) for hi in range(1, 40) for lo in range(hi)]
    df = spark.createDataFrame(pairs, "lo int, hi int").select("lo", "hi", fattest(F.col("lo"), F.col("hi")).alias("f"))
    for r in df.collect():
        assert r.f == max(range(r.lo + 1, r.hi + 1), key=lambda d: d & -d)


def brute_trie(seqs):
    """{id: [(token, weight)]} -> {path: (id, parent, members, children, leaves, saved, ends)}"""
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = {}
    for path in sorted(members, key=len, reverse=True):
        kids = [p for p in out if len(p) == len(path) + 1 and p[:-1] == path]
        cost = (len(members[path]) - 1) * path[-1][1] if path else 0
        ends = ",".join(map(str, sorted(c for c in members[path] if len(seqs[c]) == len(path))))
        out[path] = [min(members[path]), min(members[path[:-1]]) if path else None, len(members[path]), len(kids),
                     sum(out[k][4] for k in kids) or 1, cost + sum(out[k][5] for k in kids),
                     hashlib.sha256(ends.encode()).hexdigest()]
    return sorted((v[0], len(p), -1 if v[1] is None else v[1], *v[2:]) for p, v in out.items())


def trie_rows(df):
    return sorted((r.id, r.depth, -1 if r.parent_id is None else r.parent_id, r.n_members, r.n_children, r.n_leaves, r.saved,
                   r.ends_sha256) for r in df.collect())


@pytest.mark.parametrize("batches", [1, 3])
def test_prefix_trie(spark, batches):
    rng = random.Random(7)
    seqs = {}
    for c in range(160):                            # a common start, chains that end inside one another, copies
        stem = [(1, 4), (2, 0), (3, 5)] * 4 if c % 3 else []
        seqs[c * 7 - 200] = stem[:rng.randrange(len(stem) + 1)] + [(rng.randrange(3), 2) for _ in range(rng.randrange(5))]
    seqs[5001] = seqs[5000] = [(9, 1)] * 70         # one long edge, and a copy
    rows = [(c, [(t * 10 + w, -t, w) for t, w in s]) for c, s in seqs.items()]
    df = spark.createDataFrame(rows, "conv long, tokens array<struct<a:long,b:long,w:long>>").repartition(3)
    assert trie_rows(prefix_trie(df, "conv", "tokens", batches)) == brute_trie(seqs)


def test_conversations(spark):
    rows = [(0, 0, "user", "a b", 1), (0, 1, "assistant", "c", 1), (0, None, "system", None, 1), (20, 1, "user", "x", 1),
            (20, 0, "user", "x", 1), (20, 0, None, "x", 1), (21, 0, "user", " two  words ", 1), (41, 5, "user", "only", 1),
            (41, 5, "user", "only", 1), (None, 0, "user", "lost", 1), (7, 0, "user", "a b", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    own = {}
    for c, t, r, x, _ in sorted(rows, key=lambda v: (v[0] is None, v[0], v[1] is not None, v[1], v[2] or "", v[3] or "")):
        if c is not None:
            own.setdefault(c, []).append(((r or "", x or ""), len((x or "").split())))
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    got = prefix_trie(rebuilt(turn_sequences(df)), "conv", "tokens")
    assert trie_rows(got) == brute_trie(seqs)
    none = df.where("conv_id = 999")
    assert prefix_trie(rebuilt(turn_sequences(none)), "conv", "tokens").count() == 0


def test_turnless_only(spark):
    df = spark.createDataFrame([(3, []), (4, [])], "conv long, tokens array<struct<a:long,b:long,w:long>>")
    assert trie_rows(prefix_trie(df, "conv", "tokens")) == brute_trie({3: [], 4: []})


def test_letters_are_of_category_l():
    from veracity.llm.langid import _LETTER
    assert not any(_LETTER.search(t) for t in ("½ ½", "²", "Ⅷ", "①", "12 _ !", "")) and all(map(_LETTER.search, ("é", "日", "ß 1")))
