"""Packing by power-of-two decomposition: pieces of binary length, one piece a sequence.

A document of n tokens is cut into as many full sequences as it fills and, for the rest, one
piece for each binary digit that is set, longest first. A sequence is one piece, so none
crosses documents and none needs padding; sequences of equal length form a bucket, from which
a trainer takes batches of equal shape.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldo.llm.common import importable
from saldo.llm.tokens import encoder

_PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
_BYTES = 4 << 20  # of ids in one Arrow batch; Python and the JVM hold each several times at once
#: Words in a cache of the encoder. Packing ends the pipeline: by then the JVM has touched its whole heap.
_WORDS = 150_000


def binary_lengths(tokens: int, longest: int) -> Iterator[int]:
    """Lengths of the pieces of a document: powers of two up to `longest`, descending."""
    for _ in range(tokens // longest):
        yield longest
    rest, bit = tokens % longest, longest >> 1
    while rest:
        if rest & bit:
            yield bit
        rest, bit = rest & ~bit, bit >> 1


def pieces(docs: DataFrame, tokenizer: str, *, end_id: int = 1, longest: int = 2048,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, bucket, sequence_id, offset), one row a piece.

    `ids` are little-endian unsigned 32-bit, `bucket` is the length, `longest` a power of two.
    Each row of `docs` is a document of its own, also where ids repeat; a null id stays null,
    a null or empty text is the end id alone. No rows give no pieces; other columns are not
    read. Texts stay in their partition: nothing is shuffled, and a lost task is run again to
    the same rows, `sequence_id` included.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        encode = encoder(tokenizer, _WORDS).encode
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                total, start = len(ids) // 4, 0
                for length in binary_lengths(total, longest):
                    rows.append((doc, start, length, total, ids[4 * start: 4 * (start + length)]))
                    start += length
                size += len(ids)
                if size >= _BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    read = importable(docs).select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))
    return (
        read.mapInArrow(cut, _PIECES)
        .withColumn("bucket", F.col("length").cast("int"))
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast(T.LongType()))
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    docs, starts, lengths, totals, ids = zip(*rows)
    kinds = [pa.int64()] * 4 + [pa.binary()]
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    arrays = [pa.array(c, k) for c, k in zip((docs, starts, lengths, totals, ids), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names)


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder for each sequence length, each with the ids of its sequences."""
    packed.write.partitionBy("bucket").parquet(path)
