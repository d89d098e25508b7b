"""Token counts of whole texts: batches in Arrow functions that return lengths only.

Rows arrive as Arrow batches; within one, long texts are cut at safe boundaries (where no token
can reach over) and the pieces are dealt into batches of about equal bytes, so neither a very
long text nor many short ones make a batch too large. No ids leave the worker, nothing is
shuffled, and a lost executor costs its own rows only.

Defined cases: null counts as an empty text with 0 bytes and 0 tokens; special strings inside a
text are encoded as the library does by default; rows that repeat are counted each; an empty
table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from veracity.llm.common import map_arrow
from veracity.llm.tokens import ChunkLengths, chunk_coder, safe_pieces


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text",
                 keep: tuple[str, ...] = ("doc_id",), batch_bytes: int = 1 << 20,
                 piece_chars: int = 1 << 16) -> DataFrame:
    """``keep`` columns, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row's whole text, without
    begin, end or other added tokens. ``tokenizer_path`` is a byte-level BPE file of `tokenizers`."""
    def run(batches):
        coder = chunk_coder(ChunkLengths, tokenizer_path)
        for b in batches:
            n_bytes, n_tokens = [0] * b.num_rows, [0] * b.num_rows
            pieces, owner, size = [], [], 0

            def flush():
                for k, n in zip(owner, coder.of_batch(pieces)):
                    n_tokens[k] += n

            for i, v in enumerate(b.column(len(keep))):
                text = v.as_py() or ""
                n_bytes[i] = len(text.encode())
                for p in safe_pieces(text, piece_chars):
                    pieces.append(p)
                    owner.append(i)
                    size += len(p)
                    if size >= batch_bytes:
                        flush()
                        pieces, owner, size = [], [], 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in range(len(keep))), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                [*names, "n_bytes", "n_tokens"])

    names = [f"k{k}" for k in range(len(keep))]                          # kept names may clash with the results'
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, names)], F.col(text_col).alias("text"))
    schema = StructType([*(rows.schema[k] for k in range(len(keep))),
                         StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    return map_arrow(rows, run, schema, keeps=True).toDF(*keep, "n_bytes", "n_tokens")
