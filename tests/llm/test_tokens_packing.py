"""Token counts and packing against the tokenizer library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from veracity.llm import tokens as T
from veracity.llm.packing import LevelPacker, pack_documents
from veracity.llm.token_counts import count_tokens

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd_texts(awkward_texts):
    rng = random.Random(1)
    parts = list("ab cD.,!'\n\t1é́ Σß<|>") + ["<|endoftext|>", " \n", "日", " ", "'s", "İ", "\x85", "\x1c"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    return [t or "" for t in awkward_texts] + ["don't I'm x's", "a\r\nb\x0bc", "word.,!? 'll", "﻿a b"] + made


def test_chunk_lengths_equal_library(odd_texts):
    lib, coder = Tokenizer.from_file(BYTES), T.ChunkLengths(BYTES)
    want = [len(lib.encode(t, add_special_tokens=False)) for t in odd_texts]
    assert coder.of_batch(odd_texts) == want
    assert coder.of_batch(odd_texts) == want                # from memory as well
    assert [sum(coder.of_batch(T.safe_pieces(t, 8))) for t in odd_texts] == want


def test_chunk_ids_equal_library(odd_texts, monkeypatch):
    monkeypatch.setattr(T, "MEMO_BYTES", 100 * T.MEMO_ENTRY)   # generations change all the time
    lib, coder = Tokenizer.from_file(WORDS), T.ChunkIds(WORDS)
    for t in odd_texts:
        assert np.frombuffer(coder.of(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_count_tokens_rows(docs, no_docs):
    lib = Tokenizer.from_file(BYTES)
    got = count_tokens(docs, BYTES, keep=("doc_id", "text", "score"), batch_bytes=64, piece_chars=16).collect()
    assert len(got) == docs.count()
    for r in got:
        t = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(lib.encode(t, add_special_tokens=False)))
    assert count_tokens(no_docs, BYTES).count() == 0


def pieces_hold_everything(rows, docs, capacity):
    lib = Tokenizer.from_file(WORDS)
    want = sorted(((r.doc_id is not None, r.doc_id or 0), [*lib.encode(r.text or "", add_special_tokens=False).ids, 2])
                  for r in docs.select("doc_id", "text").collect())
    by_doc = {}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc.setdefault((r.doc_id is not None, r.doc_id or 0), []).append((r.start, ids, r.doc_tokens))
    total = {}
    for k, ids in want:
        total.setdefault(k, []).append(ids)
    assert set(by_doc) == set(total)
    for k, parts in by_doc.items():
        assert sum(len(i) for _, i, _ in parts) == sum(map(len, total[k]))
        if len(total[k]) == 1:
            parts.sort()
            assert [x for _, i, _ in parts for x in i] == total[k][0]
            assert [s for s, _, _ in parts] == list(np.cumsum([0] + [len(i) for _, i, _ in parts[:-1]]))
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == list(np.cumsum([0] + [n for _, n in w[:-1]]))
        assert sum(n for _, n in w) <= capacity
    return windows


@pytest.mark.parametrize("capacity,max_open", [(4096, 2048), (64, 4), (8, 2)])
def test_packing_round_trip(docs, capacity, max_open):
    rows = pack_documents(docs, WORDS, capacity=capacity, max_open=max_open).collect()
    windows = pieces_hold_everything(rows, docs, capacity)
    short = sum(sum(n for _, n in w) < capacity for w in windows.values())
    assert short <= docs.rdd.getNumPartitions()             # one window that is not full per task


def test_packing_empty_table(no_docs):
    assert pack_documents(no_docs, WORDS).count() == 0


def test_level_choice_minimises_sum_of_squares():
    rng = random.Random(3)
    p = LevelPacker(16, 1000)
    for doc in range(300):
        size = rng.randint(1, 15)
        before = p.count.copy()

        def cost(level):
            n = before.copy()
            if level:
                n[level] -= 1
            if level + size < 16:
                n[level + size] += 1
            return int((n ** 2).sum())

        options = [0] + [h for h in range(1, 17 - size) if before[h]]
        assert cost(p.level_for(size)) == min(map(cost, options))
        p.add(doc, np.arange(size, dtype="<u4"))


def test_crc_is_unsigned_and_little_endian(spark):
    from pyspark.sql import functions as F
    ids = np.array([2, 49407, 1 << 20], "<u4").tobytes()
    got = spark.createDataFrame([(bytearray(ids),)], "ids binary").select(F.crc32("ids")).first()[0]
    assert got == zlib.crc32(ids)


@pytest.mark.parametrize("name, renamed", [("start", "piece_start"), ("IDS", "piece_ids")])
def test_packing_clashing_id_names(spark, name, renamed):
    docs = spark.createDataFrame([(7, "one two"), (8, None)], f"{name} long, text string")
    out = pack_documents(docs, WORDS, id_col=name)
    assert renamed in out.columns and len({c.lower() for c in out.columns}) == len(out.columns) == 7
    assert sorted(r[0] for r in out.collect()) == [7, 8]


def test_chunk_memory_is_bounded_and_changes_no_id(spark):
    from veracity.llm import tokens as T
    from veracity.llm.queries import packed, public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    small, text = T.ChunkIds(path), " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{k // 676}" for k in range(3000))
    small.memo_bytes = 200 * T.MEMO_ENTRY
    got = [small.of(text[lo:lo + 500]) for lo in range(0, len(text), 500)]
    assert len(small.known) + len(small.known.older) < 500
    large = T.ChunkIds(path)
    assert got == [large.of(text[lo:lo + 500]) for lo in range(0, len(text), 500)]
    assert len(large.known) + len(large.known.older) > 2000
    docs = spark.createDataFrame([(k, text[k * 7:]) for k in range(20)], "doc_id long, text string")
    cols = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(packed(docs, memo_bytes=1 << 12).select(cols).collect()) == sorted(packed(docs).select(cols).collect())


def test_other_operators_start_without_remembered_chunks(spark):
    from veracity.llm import common
    common.REMEMBERED["coder"] = object()
    common.begin_task(keeps=True)
    assert common.REMEMBERED
    common.begin_task(keeps=False)
    assert not common.REMEMBERED
