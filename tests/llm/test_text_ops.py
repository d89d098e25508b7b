"""Chat formatting, license scans, language ID, URL filters, decontamination against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity.llm import urls as U
from veracity.llm.chat import escaped, format_conversations, loss_text, parsed, unescaped
from veracity.llm.decontam import benchmark_hits, contaminated, hit_words
from veracity.llm.langid import BiGRU, UNKNOWN, identify_languages, predict_language, train_language_model
from veracity.llm.licenses import NOTICES, PHRASES, scan_licenses

from .conftest import lower

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return ALNUM.findall(lower(t))


# -- chat --------------------------------------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string, formatted string, k int"


def test_chat_round_trip(spark):
    rng = random.Random(6)
    parts = ["<|im_start|>", "<|im_end|>", "\n", "<", "\\", "|", "<|", "<\\|", "<\\\\|", "a b", "assistant", "ok", "<|n|>", "日"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb", "<|im_end|>", None]),
             None if rng.random() < 0.1 else "".join(rng.choices(parts, k=rng.randint(0, 8))), "x", 1)
            for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(None, None, None, None, None, None), (3, 0, "user", "same turn", "x", 1), rows[0]]
    df = spark.createDataFrame(rows, CONV).repartition(4)
    got = format_conversations(df).select("*", parsed(F.col("formatted")).alias("turns"), loss_text().alias("loss"))
    want = {}
    for c, t, r, x, *_ in sorted(rows, key=lambda v: ((v[1] is not None, v[1] or 0), v[2] or "", v[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    out = {r.conv_id: r for r in got.collect()}
    assert set(out) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in out[c].turns] == turns
        assert out[c].loss == "".join(x for r, x in turns if r == "assistant")
        plain = sum(len(r) + len(x) + 25 - 1 for r, x in turns)
        assert len(out[c].formatted) >= plain
        assert out[c].formatted.count("<|im_start|>") == len(turns) == out[c].formatted.count("<|im_end|>")
    assert format_conversations(spark.createDataFrame([], CONV)).count() == 0


def test_plain_text_is_not_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a < b | c <| d", None, None)], CONV)
    assert format_conversations(df).first().formatted == "<|im_start|>user\na < b | c <| d<|im_end|>\n"


def test_escape_is_reversible(spark):
    texts = ["".join(random.Random(k).choices("<\\|a", k=12)) for k in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "<|" not in r.e


# -- licenses ----------------------------------------------------------------------------------

def names_notice(label, block, before):
    """Whether a block, ``before`` being the word ahead of it, says what tells its notice from the others."""
    held, b = set(block) & {w for t in NOTICES.values() for w in t.split()}, [before, *block]
    ahead = [b[i - 1] for i in range(1, len(b)) if b[i] == "general"]
    if label in ("agpl", "apache"):
        return {"agpl": "affero", "apache": "apache"}[label] in held
    if label in ("cc-by-nc", "cc-by-sa"):
        own = label[-2:]
        return any(b[i] == own and {"cc", "by"} & set(b[max(i - 3, 0):i]) for i in range(1, len(b)))
    if label == "gpl":
        return not ahead or any(w not in ("affero", "lesser", "library") for w in ahead)
    if label == "lgpl":
        return "lesser" in held or "library" in held and "library" in ahead
    return True


def brute_license(t):
    w, places, base = words(t), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    named, near = {}, {}
    lines = (t or "").split("\n")
    for lw in map(words, lines if len(lines) == 1 else [*lines, t]):
        for a in [0] if len(lw) <= 64 else range(0, len(lw) - 32, 32):
            b = lw[a:a + 64]
            for label, notice in NOTICES.items():
                n = set(notice.split())
                share = len(n & set(b)) / len(n)
                if 100 * len(n & set(b)) >= 80 * len(n):
                    near[label] = max(near.get(label, 0.0), share)
                    if names_notice(label, b, lw[a - 1] if a else ""):
                        named[label] = max(named.get(label, 0.0), share)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | set(named))), 1.0 if places else max(named.values(), default=0.0),
            ",".join(sorted(near)), max(near.values(), default=0.0))


def test_license_scan(spark, docs, no_docs, base_words):
    rng, extra = random.Random(9), []
    for k in range(160):
        notice = rng.choice(list(NOTICES.values())).split()
        for _ in range(rng.choice([0, 1, 2, 3, 5])):
            notice[rng.randrange(len(notice))] = rng.choice([*base_words[:9], "general", "library", "nc", "sa", "by", "affero"])
        if k % 4 == 0:                                                   # wrapped over lines
            notice.insert(rng.randrange(len(notice)), "\n")
        before = [rng.choice(base_words) for _ in range(rng.choice([0, 3, 40, 90]))]
        extra.append(" ".join(before) + rng.choice(["\n", " "]) + " ".join(notice).upper())
    extra += ["cc by cc by mit license, MIT License", "gnu general public license" * 2, "apache\nlicense", "cc-by cc  by"]
    extra += [t for t, _ in NEAR] + [t for t, _ in WRAPPED] + [None, "", "\n\n"]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(1000 + k, t) for k, t in enumerate(extra)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(str((r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score,
                                 r.notices, r.notice_score))) for r in scan_licenses(df).collect())
    assert got == sorted(str((d, brute_license(t))) for d, t in rows)
    assert scan_licenses(no_docs).count() == 0
    none = spark.createDataFrame([(1, "nothing here")], "w long, places string")
    assert scan_licenses(none, "w", "places").first().labels == ""


GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General "
       "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
       "option) any later version.")
NEAR = [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
    ("Licensed under CC BY-SA 4.0.", "cc-by,cc-by-sa"),
    ("Licensed under CC BY 4.0. Dans sa maison.", "cc-by"),
    ("Licensed under CC BY-NC-SA 4.0.", "cc-by,cc-by-nc,cc-by-sa"),
    (GNU.format("program", ""), "gpl"),
    (GNU.format("program", "Affero "), "agpl"),
    (GNU.format("library", "Lesser "), "lgpl"),
    (GNU.format("library", "Library "), "lgpl"),
    (GNU.format("program", "Affero ") + " " + GNU.format("library", "Lesser "), "agpl,lgpl"),
    ("This work is licensed under the GNU General Public License version 2.0", "gpl"),
    ("General Public License version 3, this work is licensed under the", "gpl"),
    ("Licensed under the Apache License, Version 2.0", "apache"),
]


def test_near_identical_notices(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(NEAR)], "doc_id long, text string")
    got = {NEAR[r.doc_id][0]: r.labels for r in scan_licenses(df).collect()}
    assert got == dict(NEAR)


WRAPPED = [
    ("""Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""", "mit"),
    ("""/* Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met: */""", "bsd"),
    ("""# Permission to use, copy, modify, and/or distribute this software
# for any purpose with or without fee is hereby granted.""", "isc"),
    *[(f"""    This {thing} is free software: you can redistribute it and/or modify
    it under the terms of the GNU {name}General Public License as
    published by the Free Software Foundation, either version 3 of the
    License, or (at your option) any later version.

    This {thing} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY. See the GNU {name}General Public License for more details.""", label)
      for thing, name, label in (("program", "Affero ", "agpl"), ("library", "Lesser ", "lgpl"), ("program", "", "gpl"))],
    ("Licensed under CC\nBY-NC\n4.0", "cc-by,cc-by-nc"),
    ("permission\nis\nhereby\ngranted", ""),
]


def test_wrapped_notices(spark, base_words):
    rng, rows = random.Random(13), []
    for k, (t, label) in enumerate(WRAPPED):
        for n in (0, 1, 31, 32, 40, 63, 200):
            around = [" ".join(rng.choice(base_words) for _ in range(n)) for _ in "ab"]
            rows.append((100 * k + len(rows), f"{around[0]}\n{t}\n{around[1]}" if n else t, label))
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    out = scan_licenses(df).collect()
    assert {r.doc_id: r.labels for r in out} == {k: label for k, _, label in rows}


# -- decontamination ---------------------------------------------------------------------------

def brute_hits(t, items):
    w, hit, found = words(t), set(), set()
    for item, it in items:
        iw = words(it)
        n = min(13, len(iw))
        for k in range(len(iw) - n + 1 if n else 0):
            for a in range(len(w) - n + 1):
                if w[a:a + n] == iw[k:k + n]:
                    hit |= set(range(a, a + n))
                    found |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_bytes", [4 << 20, 200])
def test_benchmark_hits(spark, docs, no_docs, base_words, block_bytes):
    rng = random.Random(12)
    items = [(k, " ".join(rng.choice(base_words[:60]) for _ in range(rng.choice([1, 3, 5, 13, 20, 40])))) for k in range(25)]
    items += [(50, None), (51, ""), (None, items[7][1] + " tail"), (7, items[7][1]), (52, "la la la la la la la la la la la la la la")]
    texts = []
    for k in range(40):
        parts = [" ".join(rng.choice(base_words[60:]) for _ in range(rng.randint(0, 80))) for _ in range(3)]
        for _ in range(2):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 13))
            parts.insert(1, "... ".join(w[a:a + rng.randint(10, 20)]).upper())
        texts.append(" ".join(parts))
    texts.append("la " * 30)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(100 + k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = benchmark_hits(df, bench, keep=("text",), block_bytes=block_bytes).select(
        "doc_id", "n_words", hit_words().alias("h"), "items", contaminated().alias("c")).collect()
    want = [str((d, *brute_hits(t, items))) for d, t in rows]
    assert sorted(str((r.doc_id, r.n_words, r.h, list(r["items"]), r.c)) for r in got) == sorted(want)
    assert benchmark_hits(no_docs, bench).count() == 0
    assert benchmark_hits(df, bench.limit(0)).where("size(items) > 0 or size(spans) > 0").count() == 0


# -- language ID -------------------------------------------------------------------------------

def test_gradients_by_finite_differences():
    m = BiGRU(["a", "b", "c"], 4)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    g = np.random.default_rng(0)
    x, y = g.integers(0, 256, (7, 5)), np.array([0, 1, 2, 1, 0])
    _, grad = m.loss_and_gradients(x, y)
    for k in m.p:
        for _ in range(6):
            i = tuple(g.integers(0, s) for s in m.p[k].shape)
            if k == "x":
                i = (i[0], int(x[g.integers(7), g.integers(5)]), i[2])
            old, step = m.p[k][i], 1e-3
            m.p[k][i] = old + step
            up = m.loss_and_gradients(x, y)[0]
            m.p[k][i] = old - step
            down = m.loss_and_gradients(x, y)[0]
            m.p[k][i] = old
            assert abs((up - down) / (2 * step) - grad[k][i]) < 2e-4


def test_prediction_equals_training_forward():
    m = BiGRU(["a", "b"], 5)
    x = np.random.default_rng(1).integers(0, 256, (9, 4)).astype(np.uint8)
    logits, _, _ = m._forward(x)
    e = np.exp(logits - logits.max(-1, keepdims=True))
    want = (e / e.sum(-1, keepdims=True)).sum(0)
    assert np.allclose(m.window_sums(x, np.ones(x.shape, np.float32)), want, atol=1e-4)
    mask = np.ones(x.shape, np.float32)
    mask[6:, 1] = 0                                         # a shorter window equals the window cut off
    cut, _, _ = m._forward(x[:6, 1:2])
    e = np.exp(cut - cut.max(-1, keepdims=True))
    assert np.allclose(m.window_sums(x, mask)[1], (e / e.sum(-1, keepdims=True)).sum((0, 1)), atol=1e-4)


def test_language_accuracy_and_awkward_rows(spark, docs, no_docs):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = identify_languages(df, keep=("lang",)).where("held_out").collect()
    assert len(out) > 150 and sum(r.lang == r.lang_pred for r in out) / len(out) > 0.95
    model = train_language_model(docs.where("lang is not null"), steps=5)
    assert model.classes == ["de", "en"]
    rows = predict_language(docs, model, keep=("doc_id", "text", "score")).toDF("d", "t", "own", "lang", "s").collect()
    assert len(rows) == docs.count()
    for r in rows:
        has = any(map(str.isalpha, r.t or ""))
        assert (r.lang == UNKNOWN) == (not has) and (0 < r.s <= 1 if has else r.s == 0)
    nothing = identify_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {UNKNOWN}
    assert identify_languages(no_docs).count() == 0


# -- URLs --------------------------------------------------------------------------------------

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = lower(host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules(spark):
    urls = ["http://A.Example.ORG/es/1", "https://example.org/en/1", "http://example.org/en/2?x#y", "https://x.com/de/5",
            "https://x.com/fr/5?a=/de/", "http://xorg/", "https://org/", "http://y.org", "nothing", None, "", "a://b://c/d",
            "http://x.com#/fr/", "http://notexample.org/es/", "//x.com/de/", "http://ÄB.com/de/ü?z", "http:///p"]
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls + urls[:2])], "page_id long, url string, host string")
    got = {r.page_id: r for r in U.filter_urls(df, RULES).collect()}
    assert len(got) == len(urls) + 2
    for k, u in enumerate(urls):
        host, path, rule, verdict = brute_rule(u)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict in ("allow", "block") and verdict in (None, got[k].verdict)
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


def test_template_tree(spark):
    """A branch with blocked labels is rejected, its quiet sibling is not, and crowded levels merge."""
    rows = [("h", f"/spam/item-{k}.html", "block") for k in range(60)] + [("h", f"/news/{k}", "allow") for k in range(60)]
    rows += [("h", f"/user/{chr(97 + k % 26)}{chr(97 + k // 26)}/post", "block" if k % 2 else "allow") for k in range(100)]
    rows += [("h", "/spam/item-1000.html", None), ("h", "/news/1000", None), ("h", "/user/zz/post", None), ("q", "/a/b", None),
             ("h", "/x/" * 12, None)]
    df = spark.createDataFrame(rows, "host string, path string, label string")
    shaped = df.select("host", U.path_shape("path", 6).alias("shape"), "label")
    out = {(r.host, "/".join(r["shape"])): r for r in U.template_verdicts(shaped).collect()}
    assert out["h", "spam/item-#.html"].blocked and not out["h", "news/#"].blocked
    users = {r.template for (h, s), r in out.items() if s.startswith("user/")}
    assert len(users) == 1 and "*" in users.pop()
    assert not out["q", "a/b"].blocked and out["h", "/".join(["x"] * 6 + ["**"])] is not None
    n, k = 220, 110
    prior = k / n                                            # all labels are of one host: its share is the prior
    assert out["h", "spam/item-#.html"].purity == pytest.approx((60 + 10 * prior) / 70)


def brute_tree(rows, z=2.0, least=5, weight=10.0, reject=0.6):
    """(host, shape, label) rows -> {(host, shape): (template, blocked)}, a level at a time."""
    count = {}
    for h, s, label in rows:
        c = count.setdefault((h, tuple(s)), [0, 0])
        c[0] += label is not None
        c[1] += label == "block"
    template = {key: key[1] for key in count}
    for level in range(max((len(s) for _, s in count), default=0), 0, -1):
        kids = {}
        for (h, s), t in template.items():
            if len(t) >= level:
                node = kids.setdefault((h, t[:level - 1]), {}).setdefault(t[level - 1], [0, 0])
                node[0] += count[h, s][0]
                node[1] += count[h, s][1]
        star = set()
        for parent, branches in kids.items():
            pn, pk = (sum(v[i] for v in branches.values()) for i in (0, 1))
            alike = []
            for child, (n, k) in branches.items():
                rest, share = pn - n, pk / pn if pn else 0
                alone = False
                if n >= least and rest:
                    alone = abs(k / n - (pk - k) / rest) > z * (share * (1 - share) * (1 / n + 1 / rest)) ** 0.5
                if not alone:
                    alike.append(child)
            if len(alike) > 1:
                star |= {(parent, c) for c in alike}
        for (h, s), t in template.items():
            if len(t) >= level and ((h, t[:level - 1]), t[level - 1]) in star:
                template[h, s] = t[:level - 1] + ("*",) + t[level:]
    by, host = {}, {}
    for (h, s), (n, k) in count.items():
        for store, key in ((by, (h, template[h, s])), (host, h)):
            v = store.setdefault(key, [0, 0])
            v[0] += n
            v[1] += k
    total = [sum(v[i] for v in host.values()) for i in (0, 1)]
    prior = total[1] / total[0] if total[0] else 0.0
    out = {}
    for (h, s), t in template.items():
        share = (host[h][1] + weight * prior) / (host[h][0] + weight)
        purity = (by[h, t][1] + weight * share) / (by[h, t][0] + weight)
        out[h, s] = ("/" + "/".join(t), purity >= reject)
    return out


def test_tree_by_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for h in ("a", "b", "c"):
        bad = {rng.randrange(30) for _ in range(4)}
        for _ in range(900):
            sec = rng.randrange(30)
            label = None if rng.random() < 0.4 else "block" if (sec in bad) == (rng.random() < 0.95) else "allow"
            path = [f"s{chr(97 + sec % 26)}{sec // 26}", *[rng.choice(("x", "y", "zz", f"n{rng.randrange(40)}")) for _ in range(rng.randrange(3))]]
            rows.append((h, path, label))
    rows += [("d", [], None), ("", ["x"], "block"), ("e", ["only"], None)]
    df = spark.createDataFrame(rows, "host string, shape array<string>, label string").repartition(5)
    got = {(r.host, tuple(r["shape"])): (r.template, r.blocked) for r in U.template_verdicts(df).collect()}
    assert got == brute_tree(rows)


def test_a_blocked_section_stays_among_many(spark):
    """As many quiet siblings as there are: the section's own labels decide."""
    for quiet in (3, 19, 20, 60):
        rows = [("h", ["bad", "#"], "block")] * 100 + [("h", [f"sec{chr(97 + k % 26)}{chr(97 + k // 26)}", "#"], "allow")
                                                       for k in range(quiet) for _ in range(8)]
        rows += [("h", ["de", "#"], None), ("h", ["fr", "#"], "allow")]
        df = spark.createDataFrame(rows, "host string, shape array<string>, label string")
        out = {r["shape"][0]: r for r in U.template_verdicts(df).collect()}
        assert out["bad"].blocked and out["bad"].template == "/bad/#"
        assert out["de"].template == out["fr"].template == "/*/#"
        assert quiet == 3 or not out["de"].blocked           # with three, most of the host's labels are blocks
