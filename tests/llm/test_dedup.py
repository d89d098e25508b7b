"""Exact dedup, line dedup and the n-gram Jaccard join against brute force."""

import hashlib
import random
import re

import pytest

from veracity.llm import cuckoo as C
from veracity.llm.components import connected_components
from veracity.llm.jaccard import jaccard_groups
from veracity.llm.line_dedup import dedup_lines

from .conftest import DOC, doc_rows, lower


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


# -- exact -------------------------------------------------------------------------------------

def test_exact_duplicates(docs, no_docs):
    rows = docs.collect()
    groups = {}
    for r in rows:
        groups.setdefault(norm(r.text), []).append(r.doc_id)
    want = sorted(
        (str(r.doc_id), str(min((i for i in groups[norm(r.text)] if i is not None), default=None)),
         len(groups[norm(r.text)]), hashlib.sha256(norm(r.text).encode()).hexdigest()) for r in rows)
    got = C.exact_duplicates(docs, keys_per_bucket=4).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.keep_id is not None)
    assert C.exact_duplicates(no_docs).count() == 0


def test_bucket_index_insert_delete_resize():
    rng, b, ref = random.Random(0), C.BucketIndex(), {}
    for i in range(20000):
        d = hashlib.sha256(str(rng.randrange(6000)).encode()).digest()
        if rng.random() < 0.3:
            assert b.remove(d) == (d in ref)
            if d in ref:
                ref[d][1] -= 1
                if not ref[d][1]:
                    del ref[d]
        else:
            assert b.add(d, i) == (d not in ref)
            ref.setdefault(d, [i, 0])[1] += 1
    assert b.keys == ref and b.resizes > 2
    assert all(b.key(d) in b.filter for d in ref)
    for d in list(ref):
        b.remove(d, 10**6)
    assert not b.keys and not b.filter.table.any()          # deletions leave nothing behind


def test_false_hit_is_verified():
    b = C.BucketIndex()
    one, two = bytes(8) + bytes([1] * 8) + bytes(16), bytes(8) + bytes([1] * 8) + bytes([9] * 16)
    assert b.add(one, 1) and b.add(two, 2)                  # same fingerprint and groups, other content
    assert not b.add(two, 3) and b.keys[two] == [2, 2] and b.verified == 2


def test_delete_rows_takes_the_least_id_again(spark):
    rng = random.Random(8)
    rows = [(k if k else None, hashlib.sha256(str(rng.choice([0, 0, rng.randint(1, 40)])).encode()).digest()) for k in range(300)]
    live = spark.createDataFrame([(i, bytearray(d)) for i, d in rows], "id long, digest binary")
    index = C.build_index(C.partial_groups(live), 4)
    first = {d: i for i, d in reversed(rows) if i is not None}
    gone = [(i, d) for i, d in rows if first.get(d) == i or rng.random() < 0.3]
    unknown = [(5000, rows[0][1]), (1, hashlib.sha256(b"?").digest())]
    out, stay = C.delete_rows(index, live, spark.createDataFrame(
        [(i, bytearray(d)) for i, d in gone + unknown], "id long, digest binary"), 4)
    want = {}
    for i, d in rows:
        if (i, d) not in gone:
            want.setdefault(d, []).append(i)
    got = {bytes(r.digest): (r.least, r.rows) for r in out.where("digest is not null").collect()}
    assert got == {d: (min((i for i in v if i is not None), default=None), len(v)) for d, v in want.items()}
    assert stay.count() == len(rows) - len(gone)
    assert out.where("digest is null").count() == 4


def test_update_index(spark):
    def change(texts, remove=False):
        rows = [(bytearray(hashlib.sha256(t.encode()).digest()), i, 1, remove) for t, i in texts]
        return spark.createDataFrame(rows, "digest binary, least long, rows long, remove boolean")

    index = C.build_index(change([(str(i), i) for i in range(50)]), 4)
    index = C.update_index(index, change([("3", 3), ("7", 7), ("none", 1)], True).unionByName(
        change([("8", 2), ("new", 99)])), 4)
    got = {bytes(r.digest): (r.least, r.rows) for r in index.where("digest is not null").collect()}
    want = {hashlib.sha256(str(i).encode()).digest(): (i, 1) for i in range(50) if i not in (3, 7, 8)}
    want |= {hashlib.sha256(b"8").digest(): (2, 2), hashlib.sha256(b"new").digest(): (99, 1)}
    assert got == want


# -- lines -------------------------------------------------------------------------------------

def words(line):
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", line))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(rows, min_words=5):
    """{(id, text): kept text}; rows in the order of the documents."""
    lines = sorted({((d is not None, d or 0), d, t) for d, t in rows if t is not None}, key=lambda x: x[0])
    seen, out = [], {}
    for _, d, t in lines:
        kept = []
        for line in t.split("\n"):
            w = words(line)
            dup = w and any(w == s or (min(len(w), len(s)) >= min_words and abs(len(w) - len(s)) <= 1
                                       and edits(w, s) <= 1) for s in seen)
            if not dup:
                kept.append(line)
            if w:
                seen.append(w)
        out[d, t] = "\n".join(kept)
    return out


@pytest.fixture(scope="module")
def line_docs(spark, base_words):
    rng = random.Random(4)
    pool = [[rng.choice(base_words) for _ in range(rng.randint(1, 14))] for _ in range(40)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rng.randint(1, 6)):
            w = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k, how = rng.randrange(len(w)), rng.random()
                if how < 0.4:
                    w[k] = rng.choice(base_words)
                elif how < 0.7 and len(w) > 1:
                    del w[k]
                else:
                    w.insert(k, rng.choice(base_words))
            text.append(rng.choice(["", " "]) + rng.choice([" ", "  "]).join(w))
        rows.append((d, "\n".join(text), "en", None, None, None, None, None))
    rows.append((60, ("x " * 500 + "y\n") * 2 + "x " * 499 + "z y", "en", None, None, None, None, None))
    return spark.createDataFrame(rows, DOC).repartition(4)


def test_line_dedup_brute_force(line_docs):
    want = brute_lines([(r.doc_id, r.text) for r in line_docs.collect()])
    got = dedup_lines(line_docs, n_lines_col="lines", n_dropped_col="gone")
    assert got.columns == [*line_docs.columns, "lines", "gone"]
    texts = {r.doc_id: r.text for r in line_docs.collect()}
    dropped = 0
    for r in got.collect():
        assert r.text == want[r.doc_id, texts[r.doc_id]]
        assert r.lines == texts[r.doc_id].count("\n") + 1
        dropped += r.gone
    assert dropped > 40


def test_line_dedup_clashing_names(spark):
    rows = [(1, "one two three four five six", 7, "a", 2), (2, "one two three four five six\nother", 8, "b", 3)]
    df = spark.createDataFrame(rows, ["__id", "__kept", "__th", "h.1", "__no"])
    out = dedup_lines(df, "__id", "__kept", n_lines_col="n", n_dropped_col="lost")
    assert out.columns == [*df.columns, "n", "lost"]
    assert sorted(map(tuple, out.collect())) == [(*rows[0], 1, 0), (2, "other", 8, "b", 3, 2, 1)]


def test_line_dedup_awkward(docs, no_docs, awkward_texts):
    rows = [(d, t) for d, t, *_ in doc_rows(awkward_texts)]
    same_id = [r for r in rows if r[0] == 10]
    got = dedup_lines(docs).collect()
    assert len(got) == len(rows) and [r for r in got if r.text is None]
    assert sum(r.doc_id == 10 for r in got) == len(same_id)
    assert any(r.doc_id == 10 and r.text == "another text under the same id" for r in got)
    assert dedup_lines(no_docs).count() == 0


# -- n-gram Jaccard ----------------------------------------------------------------------------

def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute_groups(rows):
    """[(id, size, component)] by comparing all pairs."""
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    return [(d, len(s), min((x for x in ids[find(i)] if x is not None), default=None))
            for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.fixture(scope="module")
def near_docs(spark, base_words):
    rng, rows = random.Random(8), []
    bases = [[rng.choice(base_words) for _ in range(n)] for n in (6, 12, 30, 80, 200, 600)]
    for d in range(160):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = rng.choice(base_words)
        if rng.random() < 0.3:
            w = w[:int(len(w) * rng.uniform(0.7, 1))]
        rows.append((d, " ".join(w), "en", None, None, None, None, None))
    return spark.createDataFrame(rows, DOC).repartition(5)


def test_jaccard_brute_force(near_docs):
    want = brute_groups([(r.doc_id, r.text) for r in near_docs.collect()])
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_groups(near_docs).collect()]
    assert sorted(got) == sorted(want)
    assert 10 < len({c for _, _, c in want}) < 150


def test_jaccard_awkward(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # A row of id 10 joins two texts' groups only through the id, which the graph does not do.
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_groups(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_groups(rows)))
    assert jaccard_groups(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(3))
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got.collect()} == want
    empty = spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")
    assert connected_components(empty).count() == 0
