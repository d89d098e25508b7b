"""Exact token ids of whole texts from those of white-space separated chunks.

Both vocabularies used here split a text before white space, so a text's ids are the ids of its
chunks one after the other, where a chunk ends before a single space or line feed between two
characters that are not white space. Chunks repeat, so a worker remembers theirs (within a
budget of bytes). A chunk of plain letters is one pre-token, which the library's model encodes directly;
every other chunk goes through the whole library, special strings included.
"""

from __future__ import annotations

import re
import struct

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from veracity.llm.common import REMEMBERED

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: White space that makes a text need the general cut: runs, other kinds, or at an end.
_ODD = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Text in which lower-casing here could differ from the library's, or touch a special string.
_WIDE = re.compile("[^\x00-\x7f\xa0-\xff]|<\\|")
#: Bytes that a coder remembers in both generations together, what one chunk of up to MEMO_LENGTH
#: letters takes of them with its result and the dictionary's share.
MEMO_BYTES = 160 << 20
MEMO_ENTRY = 200
MEMO_LENGTH = 64

_byte = {b: c for b in range(256) for c in [ByteLevel(add_prefix_space=False, use_regex=False)
                                            .pre_tokenize_str(chr(b))[0][0][-1]] if b < 128}


def _byte_table() -> dict[int, str]:
    """Latin-1 code point of each byte -> the character that byte-level models use for it."""
    table, pre = dict(_byte), ByteLevel(add_prefix_space=False, use_regex=False)
    for lead in (0xC2, 0xC3):
        for tail in range(0x80, 0xC0):
            a, b = pre.pre_tokenize_str(bytes([lead, tail]).decode())[0][0]
            table[lead], table[tail] = a, b
    return table


class _Chunks(dict):
    """What is known of chunks. With half of ``MEMO_BYTES`` it becomes the older generation, from which
    chunks that still occur come back; the rest is forgotten with the next change."""

    def __init__(self, coder: _Coder, older: dict):
        super().__init__()
        self.make, self.older, self.used = coder.make, older, 0

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if value is None:
                return 0
        if len(key) <= MEMO_LENGTH:
            self[key] = value
            self.used += 1
        return value


class _Coder:
    #: What this coder remembers at most; ``chunk_coder`` sets it for each task.
    memo_bytes = MEMO_BYTES

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.model, self.table = self.tok.model, _byte_table()
        self.marks: dict = {}
        self.known = _Chunks(self, {})

    def age(self) -> None:
        if self.known.used * MEMO_ENTRY > self.memo_bytes // 2:
            self.known.older = {}
            self.known = _Chunks(self, self.known)

    def parts(self, chunk: str) -> tuple[str, str] | None:
        """Plain letters and the punctuation after them, or None."""
        letters = chunk.rstrip(".,;:!?")
        if letters.isascii():
            return (letters, chunk[len(letters):]) if letters.isalpha() else None
        return (letters, chunk[len(letters):]) if _WORD.fullmatch(letters) else None

    def tokens(self, letters: str) -> list:
        return self.model.tokenize(letters if letters.isascii() else
                                   letters.encode().decode("latin-1").translate(self.table))


class ChunkLengths(_Coder):
    """Number of ids of a chunk, for a byte-level vocabulary whose words carry their leading space.

    A key stands for itself with a space before it; one that begins with a line feed, for itself.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.space, self.feed = self.table[0x20], self.table[0x0A]
        self.pending: list[tuple[int, str]] = []
        self.at = 0

    def mark(self, chars: str) -> int:
        if not chars:
            return 0
        n = self.marks.get(chars)
        if n is None:
            n = len(self.model.tokenize(chars))
            if len(chars) < 4:
                self.marks[chars] = n
        return n

    def make(self, key: str) -> int | None:
        feed = key[:1] == "\n"
        found = self.parts(key[1:] if feed else key)
        if found is None:
            self.pending.append((self.at, key if feed else " " + key))
            return None
        if feed:
            return len(self.model.tokenize(self.feed)) + len(self.tokens(found[0])) + self.mark(found[1])
        if found[1]:
            return self.known[found[0]] + self.mark(found[1])
        word = key if key.isascii() else key.encode().decode("latin-1").translate(self.table)
        return len(self.model.tokenize(self.space + word))

    def of_batch(self, pieces: list[str]) -> list[int]:
        """Numbers of ids of texts; what is not plain is encoded in one batch of distinct chunks."""
        self.age()
        self.pending, get, out = [], self.known.__getitem__, []
        for self.at, t in enumerate(pieces):
            if not t:
                out.append(0)
            elif _ODD.search(t):
                self.pending.extend((self.at, c) for c in _CUT.split(t))
                out.append(0)
            else:
                head, *rest = t.replace("\n", " \n").split(" ")
                self.pending.append((self.at, head))
                out.append(sum(map(get, rest)))
        distinct = list({c for _, c in self.pending})
        known = dict(zip(distinct, map(len, self.tok.encode_batch_fast(distinct, add_special_tokens=False))))
        for i, c in self.pending:
            out[i] += known[c]
        return out


class ChunkIds(_Coder):
    """Ids of a chunk as little-endian 32-bit bytes, for a vocabulary that drops white space."""

    def mark(self, chars: str) -> bytes:
        ids = self.marks.get(chars)
        if ids is None:
            ids = _packed([t.id for t in self.model.tokenize(chars)])
            if len(chars) < 4:
                self.marks[chars] = ids
        return ids

    def make(self, key: str) -> bytes:
        found = self.parts(key) if key.islower() else None
        if found is None:
            return _packed(self.tok.encode(key, add_special_tokens=False).ids)
        if found[1]:
            return self.known[found[0]] + self.mark(found[1])
        return _packed([t.id for t in self.tokens(key)])

    def of(self, text: str) -> bytes:
        if not _WIDE.search(text):
            text = text.lower()
        chunks, out = text.replace("\n", " ").split(" "), []
        for lo in range(0, len(chunks), 1 << 16):
            self.age()
            out.append(b"".join(map(self.known.__getitem__, chunks[lo:lo + (1 << 16)])))
        return out[0] if len(out) == 1 else b"".join(out)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def chunk_coder(kind: type, path: str, memo_bytes: int = MEMO_BYTES):
    """One coder per worker process and vocabulary file: what it remembers serves later tasks of its operator."""
    if (kind, path) not in REMEMBERED:
        REMEMBERED[kind, path] = kind(path)
    REMEMBERED[kind, path].memo_bytes = memo_bytes
    return REMEMBERED[kind, path]


def safe_pieces(text: str, limit: int) -> list[str]:
    """``text`` cut into pieces of about ``limit`` characters, only where no token can reach over."""
    out, lo = [], 0
    while len(text) - lo > limit:
        m = _CUT.search(text, lo + limit)
        if m is None:
            break
        out.append(text[lo:m.start()])
        lo = m.start()
    out.append(text[lo:])
    return out
