"""Small fixtures: the awkward rows that every operator must take (nulls, empty and very long texts,
ties, repeated rows, empty tables, extra columns whose names clash with an operator's own)."""

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, node string, n_words int"
UPPER = {i: i + 32 for i in range(65, 91)}


def lower(text):
    return (text or "").translate(UPPER)


@pytest.fixture(scope="session")
def base_words():
    rng = random.Random(5)
    return ["".join(rng.choice("abdeiklmnorstuz") for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def awkward_texts(base_words):
    rng = random.Random(11)
    text = [" ".join(rng.choice(base_words) for _ in range(n)) for n in (3, 7, 40, 60, 60, 120, 900)]
    near = text[3].split()
    near[30] = "changed"
    return [
        None, "", "   ", "\n\n", "!!! ... ???", "word", "Word", "word  \t word", "word word",
        *text, text[3], " ".join(near), text[3] + " and one more", text[5].upper(),
        text[2] + "\n" + text[4], text[4] + "\n" + text[2] + "\nthe  end of it\n\nthe end of it",
        "Straße ÀÉ ñandú 日本語 テキスト 🙂 é", "x <|endoftext|> y <|im_end|>\n<|im_start|>user\nhi <\\| <|",
        "ab " * 3000, "one line " * 4 + "\n" + "one line " * 4, text[6] + "\n" + text[6],
    ]


def doc_rows(texts):
    langs = [None, "en", "de", "en"]
    rows = [(k, t, langs[k % 4], "src0", len(t or ""), 0.5, "x", 1) for k, t in enumerate(texts)]
    rows.append(rows[10])                                   # a row that repeats in full
    rows.append((10, "another text under the same id", "en", "src1", 30, None, None, None))
    rows.append((None, texts[12], "de", None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def docs(spark, awkward_texts):
    return spark.createDataFrame(doc_rows(awkward_texts), DOC).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


def key(row, n):
    return tuple((v is not None, v) for v in row[:n])
