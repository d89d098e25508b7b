"""Exact dedup through a cuckoo-filter index of content digests.

The index is split into buckets by digest. A bucket has its keys (a digest, the id that stays and
the number of live rows, one row each) and a cuckoo filter over them: two candidate slots groups
per key, four 16-bit fingerprints each, so it answers "surely new" from a few bytes a key. A
"perhaps known" answer is verified against the bucket's stored content keys (the SHA-256 of the
normalised text); a false one is inserted like a new key. Live digests can be deleted. When an
insertion finds no room after a bounded number of moves, the filter doubles and is filled anew
from the stored keys, so overflow loses nothing.

Two uses:

* ``exact_duplicates`` indexes a table of documents: rows are normalised and digested where they
  are read, copies are counted map-side and again under a salt, and only (digest, least id, count)
  reaches the bucket's task, where every partial row goes through the index. A text that a third
  of all rows share is a few partial rows there.
* ``update_index`` applies insertions and deletions to a stored index (a DataFrame of its buckets,
  filters included), bucket by bucket.

Texts are equal when identical after replacing each run of white space (space, tab to carriage
return) by one space.

Defined cases: null counts as empty text; rows that repeat an id are rows like any other; a null
id is never the least id of a group unless no row has another; an empty table gives no rows.
Only the id and the text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.llm.common import cut_lineage, worker_path

#: Slots of a slot group, and moves before a filter gives up and is doubled.
SLOTS = 4
MAX_MOVES = 500
#: Index keys that one bucket is planned for; the number of buckets follows the number of rows.
KEYS_PER_BUCKET = 50_000


class CuckooFilter:
    """Fingerprints of 64-bit keys in ``2**log2_groups`` groups of ``SLOTS`` slots; 0 is empty."""

    def __init__(self, log2_groups: int = 6, table: bytes | None = None):
        self.mask = (1 << log2_groups) - 1
        self.table = (np.zeros((self.mask + 1, SLOTS), np.uint16) if table is None
                      else np.frombuffer(table, np.uint16).reshape(-1, SLOTS).copy())
        self.mask = len(self.table) - 1
        self._turn = 0

    @staticmethod
    def _print(key: int) -> int:
        return (key & 0xFFFF) or 1

    def _other(self, group: int, mark: int) -> int:
        # The partner group depends on the mark alone, and the partner of the partner is the group.
        return (group ^ (mark * 0x5BD1E995 >> 3)) & self.mask

    def _groups(self, key: int) -> tuple[int, int, int]:
        mark, group = self._print(key), (key >> 16) & self.mask
        return mark, group, self._other(group, mark)

    def __contains__(self, key: int) -> bool:
        mark, a, b = self._groups(key)
        return bool((self.table[a] == mark).any() or (self.table[b] == mark).any())

    def _place(self, group: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[group] == 0)
        if len(free):
            self.table[group, free[0]] = mark
        return bool(len(free))

    def insert(self, key: int) -> bool:
        """False when there is no room; the table is then as it was before."""
        mark, a, b = self._groups(key)
        if self._place(a, mark) or self._place(b, mark):
            return True
        moves, group = [], a
        for _ in range(MAX_MOVES):
            slot = self._turn = (self._turn + 1) % SLOTS
            moves.append((group, slot, int(self.table[group, slot])))
            mark, self.table[group, slot] = int(self.table[group, slot]), mark
            group = self._other(group, mark)
            if self._place(group, mark):
                return True
        for g, s, m in reversed(moves):
            self.table[g, s] = m
        return False

    def delete(self, key: int) -> bool:
        """Remove one fingerprint of a key that was inserted (the caller has verified that)."""
        mark, a, b = self._groups(key)
        for g in (a, b):
            at = np.flatnonzero(self.table[g] == mark)
            if len(at):
                self.table[g, at[0]] = 0
                return True
        return False


class BucketIndex:
    """One bucket: stored keys and the filter over the live ones."""

    def __init__(self, filter_bytes: bytes | None = None):
        self.filter = CuckooFilter(table=filter_bytes) if filter_bytes else CuckooFilter()
        self.keys: dict[bytes, list] = {}             # digest -> [least id, live rows]
        self.lookups = self.verified = self.resizes = 0

    @staticmethod
    def key(digest: bytes) -> int:
        return int.from_bytes(digest[8:16], "little")  # the first bytes choose the bucket

    def restore(self, digest: bytes, least, rows: int) -> None:
        """A stored key whose fingerprint the stored filter already has."""
        self.keys[digest] = [least, rows]

    def _insert(self, digest: bytes) -> None:
        while not self.filter.insert(self.key(digest)):
            groups = len(self.filter.table)
            while True:                                # resize from the stored keys
                groups *= 2
                self.resizes += 1
                bigger = CuckooFilter(groups.bit_length() - 1)
                if all(bigger.insert(self.key(d)) for d in self.keys if d != digest):
                    break
            self.filter = bigger

    def add(self, digest: bytes, least, rows: int = 1) -> bool:
        """Add live rows of a content; True if it is new to the bucket."""
        self.lookups += 1
        if self.key(digest) in self.filter:
            self.verified += 1
            entry = self.keys.get(digest)              # the stored content decides
            if entry is not None:
                if entry[0] is None or (least is not None and least < entry[0]):
                    entry[0] = least
                entry[1] += rows
                return False
        self.keys[digest] = [least, rows]
        self._insert(digest)
        return True

    def remove(self, digest: bytes, rows: int = 1) -> bool:
        """Take live rows of a content away; its digest leaves with the last. False if unknown."""
        if self.key(digest) not in self.filter or digest not in self.keys:
            return False
        self.keys[digest][1] -= rows
        if self.keys[digest][1] <= 0:
            del self.keys[digest]
            self.filter.delete(self.key(digest))
        return True


def normalised(text: str | Column) -> Column:
    """The text with each run of white space replaced by one space; null is empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest)``: the SHA-256 of the normalised text as 32 bytes."""
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"))


def bucket_of(digest: str, buckets: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 7)), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def partial_groups(rows: DataFrame, salts: int = 16) -> DataFrame:
    """``(digest, least, rows)``: copies counted before they meet, a content in ``salts`` rows at most."""
    salt = F.pmod(F.xxhash64("id"), F.lit(salts))
    return (rows.groupBy("digest", salt.alias("salt")).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"))
            .drop("salt"))


def build_index(partials: DataFrame, buckets: int) -> DataFrame:
    """The index of partial groups: rows ``(bucket, digest, least, rows, filter)``; each bucket has
    one row without a digest that carries its filter."""
    id_type = partials.schema["least"].dataType.simpleString()
    empty = partials.sparkSession.createDataFrame(
        [], f"bucket int, digest binary, least {id_type}, rows long, filter binary")
    return update_index(empty, partials.withColumn("remove", F.lit(False)), buckets)


def update_index(index: DataFrame, changes: DataFrame, buckets: int) -> DataFrame:
    """The index after ``changes(digest, least, rows, remove)``; insertions of a batch come first.

    Buckets are cogrouped, so each task sees one bucket's keys, its filter and its changes.
    Deletions name live digests; of an unknown digest they change nothing. The least id of a
    content that stays is kept when some of its rows go; ``delete_rows`` takes it again.
    """
    id_type = index.schema["least"].dataType.simpleString()
    worker_path(index.sparkSession)

    def apply(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        filters = old.loc[old["digest"].isna(), "filter"] if len(old) else []
        b = BucketIndex(bytes(next(iter(filters))) if len(filters) else None)
        for d, least, n in old.loc[old["digest"].notna(), ["digest", "least", "rows"]].itertuples(index=False):
            b.restore(bytes(d), None if pd.isna(least) else least, int(n))
        new = new.sort_values("remove", kind="stable")
        for d, least, n, remove in new[["digest", "least", "rows", "remove"]].itertuples(index=False):
            if remove:
                b.remove(bytes(d), int(n))
            else:
                b.add(bytes(d), None if pd.isna(least) else least, int(n))
        bucket = int((old if len(old) else new)["bucket"].iloc[0])
        rows = [(bucket, d, least, n, None) for d, (least, n) in b.keys.items()]
        rows.append((bucket, None, None, None, b.filter.table.tobytes()))
        out = pd.DataFrame(rows, columns=["bucket", "digest", "least", "rows", "filter"])
        if id_type in ("bigint", "int"):
            out["least"] = pd.array(out["least"], dtype="Int64")
        out["rows"] = pd.array(out["rows"], dtype="Int64")
        return out

    keyed = changes.select(bucket_of("digest", buckets).alias("bucket"), "digest", "least", "rows", "remove")
    return (index.groupBy("bucket").cogroup(keyed.groupBy("bucket"))
            .applyInPandas(apply, f"bucket int, digest binary, least {id_type}, rows long, filter binary"))


def delete_rows(index: DataFrame, live: DataFrame, gone: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The index after the rows ``gone(id, digest)`` leave ``live(id, digest)``, and the rows that stay.

    Rows that are not live change nothing. A content that lost rows takes its least id again from those
    that stay, counted in salted parts, so the index never names a deleted row."""
    same = F.col("r.id").eqNullSafe(F.col("g.id")) & (F.col("r.digest") == F.col("g.digest"))
    lost = live.alias("r").join(gone.alias("g"), same, "left_semi")
    stay = live.alias("r").join(gone.alias("g"), same, "left_anti")
    out = update_index(index, partial_groups(lost).withColumn("remove", F.lit(True)), buckets)
    again = (partial_groups(stay.join(lost.select("digest").distinct(), "digest", "left_semi"))
             .groupBy("digest").agg(F.min("least").alias("again"), F.lit(True).alias("changed")))
    out = out.join(again, "digest", "left").withColumn("least", F.when(F.col("changed"), F.col("again")).otherwise(F.col("least")))
    return out.select(*index.columns), stay


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """One row per row of ``docs``: ``id_col, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the smallest id stays (of rows that repeat this id, all)."""
    rows = cut_lineage(digests(docs, id_col, text_col))
    buckets = max(1, math.ceil(rows.count() / keys_per_bucket))
    index = build_index(partial_groups(rows), buckets).where("digest is not null")
    out = rows.join(index.select("digest", "least", "rows"), "digest")
    return out.select(F.col("id").alias(id_col), F.col("least").alias("keep_id"), F.col("rows").alias("group_size"),
                      F.coalesce(F.col("id") == F.col("least"), F.col("least").isNull()).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))
