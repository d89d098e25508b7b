"""Text measures of reviews by the batch: what ``functions.text`` says of one text, for all texts of an Arrow batch.

The expressions of ``functions.text`` read a text once for each pattern and word. Here its bytes are read with a few
table look-ups and one automaton a word list. The results are the same; characters are classified by Java's tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from veracity.arrow import JAVA_UPPER, JAVA_WORD, java_chars, map_arrow
from veracity.functions import lexicons as lx
from veracity.functions import text as tx

#: Columns that ``measured`` adds have this before their names.
MEASURE = "text_measure_"
#: What is taken at once: bytes of texts (a longer text goes alone).
STEP_BYTES = 1 << 18

_WHITE = np.array(sorted(map(ord, tx.WHITESPACE_CHARS)), np.int32)
_WHITE_ASCII = np.isin(np.arange(256), _WHITE[_WHITE < 128])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# What ``functions.text.ODD_LETTERS`` stand for in a pattern that ignores case.
_ODD = dict(zip(tx.ODD_LETTERS, "iisk"))
_ODD_CODES = np.array([ord(c) for c in _ODD], np.int32)
_BEYOND = r"\x{80}-\x{10FFFF}"


def steps(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The first row, the bytes and the places of the texts in them (with an end), some texts at a time."""
    col = texts.cast(pa.large_binary())
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + STEP_BYTES, side="right")) - 1)
        yield lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def beyond_ascii(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, number of bytes and code of each character beyond ASCII."""
    lead = np.flatnonzero(data >= 0xC0)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]) if len(lead) else data
    first = data[lead].astype(np.int32)
    size = 2 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
    code = first & np.array([0, 0, 0x1F, 0x0F, 0x07], np.int32)[size]
    for k in (1, 2, 3):
        more = size > k
        code[more] = (code[more] << 6) | (padded[lead[more] + k] & 0x3F)
    return lead, size, np.minimum(code, 0x10FFFF)


def mark(inside: np.ndarray, lead: np.ndarray, size: np.ndarray, which: np.ndarray) -> None:
    """Sets all bytes of the characters ``which``."""
    for k in range(4):
        at = lead[which & (size > k)] + k
        inside[at[at < len(inside)]] = True


def _per_text(at: np.ndarray, rel: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(at, rel))


class Measures:
    """Measures the texts of a step, by name."""

    #: The bounded word lists.
    BOUNDED = {"spam_scoring": lx.SPAM_PHRASES_SCORING + lx.SPAM_WORDS_SCORING, "spam_loader": lx.SPAM_WORDS_LOADER,
               "spam_trainer": lx.SPAM_WORDS_TRAINER, "positive_word": lx.POSITIVE_WORDS, "negative_word": lx.NEGATIVE_WORDS,
               "negative_loader": lx.NEGATIVE_WORDS_LOADER}
    SUBSTRING = {"positive_hql": lx.POSITIVE_WORDS, "negative_hql": lx.NEGATIVE_WORDS, "mismatch_hql": lx.MISMATCH_WORDS_SQL}
    COUNTS = ["word_count", "uppercase_count", "exclamation_count"]
    NAMES = [*COUNTS, "has_url", *BOUNDED, *SUBSTRING]

    def __init__(self, upper: bytes, word: bytes, names: Sequence[str]):
        self.upper, self.word = (np.unpackbits(np.frombuffer(b, np.uint8)).astype(bool) for b in (upper, word))
        self.upper_ascii = np.concatenate([self.upper[:128], np.zeros(128, bool)])
        self.names = names

    def of(self, data: np.ndarray, rel: np.ndarray) -> list[np.ndarray]:
        lead, size, code = beyond_ascii(data)
        low = self._folded(data, rel, lead, code)
        out = []
        for name in self.names:
            if name == "word_count":
                white = _WHITE_ASCII[data]
                mark(white, lead, size, np.isin(code, _WHITE))
                begin = np.concatenate([[True], white[:-1]]) if len(data) else white
                begin[rel[:-1][rel[:-1] < len(data)]] = True
                out.append(_per_text(np.flatnonzero(begin & ~white), rel).astype(np.int32))
            elif name == "uppercase_count":
                n = _per_text(np.flatnonzero(self.upper_ascii[data]), rel) + _per_text(lead[self.upper[code]], rel)
                out.append(n.astype(np.int32))
            elif name == "exclamation_count":
                out.append(_per_text(np.flatnonzero(data == 0x21), rel).astype(np.int32))
            elif name == "has_url":
                out.append(_matches(_texts(data, rel), lx.URL_PATTERN))
            elif name in self.SUBSTRING:
                out.append(_matches(low, "|".join(self.SUBSTRING[name])))
            else:
                hit = self._bounded(low, self.BOUNDED[name], len(lead) > 0)
                if name == "spam_scoring":
                    hit |= _matches(_texts(_LOWER[data], rel), lx.URL_PATTERN)
                out.append(hit)
        return out

    @staticmethod
    def _folded(data: np.ndarray, rel: np.ndarray, lead: np.ndarray, code: np.ndarray) -> pa.Array:
        """The texts with A-Z and the odd letters as a-z."""
        low = _texts(_LOWER[data], rel)
        odd = lead[np.isin(code, _ODD_CODES)]
        if not len(odd):
            return low
        rows, table = low.to_pylist(), str.maketrans(_ODD)
        for k in set((np.searchsorted(rel, odd, side="right") - 1).tolist()):
            rows[k] = rows[k].translate(table)
        return pa.array(rows, pa.large_string())

    def _bounded(self, low: pa.Array, words: list[str], beyond: bool) -> np.ndarray:
        """Whether one of ``words`` stands between characters that belong to no word."""
        some, no = "|".join(words), rf"[^a-z0-9_{_BEYOND}]"
        hit = _matches(low, rf"(?:^|{no})(?:{some})(?:{no}|$)")
        if beyond:      # a neighbour beyond ASCII: Java's table decides
            near = _matches(low, rf"[{_BEYOND}](?:{some})|(?:{some})[{_BEYOND}]") & ~hit
            for k in np.flatnonzero(near):
                hit[k] = any(self._stands_alone(low[k].as_py(), w) for w in words)
        return hit

    def _stands_alone(self, text: str, word: str) -> bool:
        at = text.find(word)
        while at >= 0:
            before, after = text[max(at - 1, 0):at], text[at + len(word):at + len(word) + 1]
            # Java's look-behind takes a character beyond 16 bits for none, as ``functions.text`` does.
            if not any(self.word[ord(c)] for c in after + (before if before < "\U00010000" else "")):
                return True
            at = text.find(word, at + 1)
        return False


def _texts(data: np.ndarray, rel: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(rel) - 1, pa.py_buffer(np.ascontiguousarray(rel, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def _matches(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).copy()


def measured(df: DataFrame, names: Sequence[str], body_col: str = "body") -> DataFrame:
    """``df`` with the measures ``names`` (of ``Measures.NAMES``) of its text; null text counts as empty."""
    upper, word = (java_chars(df.sparkSession, p) for p in (JAVA_UPPER, JAVA_WORD))
    place = df.columns.index(body_col)

    def measure(batches):
        by = Measures(upper, word, names)
        for b in batches:
            body = b.column(place)
            full = pc.fill_null(body, "") if body.null_count else body
            parts = [by.of(data, rel) for _, data, rel in steps(full)]
            found = [pa.array(np.concatenate(p)) for p in zip(*parts)]
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, *found], [*b.schema.names, *(MEASURE + n for n in names)])

    kinds = {n: IntegerType() if n in Measures.COUNTS else BooleanType() for n in names}
    return map_arrow(df, measure, StructType([*df.schema.fields, *(StructField(MEASURE + n, kinds[n], False) for n in names)]))


def ready(df: DataFrame, name: str, otherwise) -> F.Column:
    """The measure ``name`` that ``df`` has, or what ``otherwise()`` makes of the text."""
    return F.col(MEASURE + name) if MEASURE + name in df.columns else otherwise()
