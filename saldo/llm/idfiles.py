"""Token ids as one concatenated array, document boundaries as Elias-Fano codes.

Files are Parquet, so that any store Spark writes to will do, and a row is a block: the ids of
some whole documents back to back in 2 or 4 bytes each, and the codes of their boundaries and
of their ascending ids. A block's boundaries take about 2 + log2(tokens / documents) bits a
document; `EliasFano.select` finds one without decoding the others.
"""

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zlib
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saldo.llm.common import importable
from saldo.llm.tokens import encoder
from saldo.sources.scratch import new_folder

_BLOCK = (
    "part int, block int, first bigint, documents int, tokens bigint, width int, ids binary, "
    "ends_low binary, ends_high binary, ends_bits int, no_id int, base bigint, "
    "keys_low binary, keys_high binary, keys_bits int"
)
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]
_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(),
          pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(),
          pa.binary(), pa.binary(), pa.int32()]
_ROWS = "doc_id bigint, part int, start bigint, n_tokens bigint, ids binary"
_EVERY = 64  # ones between two samples of select


@dataclass
class EliasFano:
    """Ascending numbers of at least 0: low bits as they are, high bits as gaps in unary."""

    count: int
    low: bytes
    high: bytes
    bits: int

    @classmethod
    def encode(cls, values) -> "EliasFano":
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls(0, b"", b"", 0)
        bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        shift = np.uint64(bits)
        high = np.zeros(n + int(v[-1] >> shift) + 1, np.uint8)
        high[(v >> shift).astype(np.int64) + np.arange(n)] = 1
        low = ((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        return cls(n, np.packbits(low).tobytes(), np.packbits(high).tobytes(), bits)

    def _lows(self, first: int, last: int) -> np.ndarray:
        if not self.bits:
            return np.zeros(last - first, np.int64)
        a, b = first * self.bits, last * self.bits
        flat = np.unpackbits(np.frombuffer(self.low, np.uint8)[a // 8: (b + 7) // 8])
        flat = flat[a % 8: a % 8 + b - a].reshape(-1, self.bits).astype(np.int64)
        return flat @ (1 << np.arange(self.bits, dtype=np.int64))

    def decode(self) -> np.ndarray:
        if not self.count:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8)))[: self.count]
        return ((ones - np.arange(self.count)) << self.bits) | self._lows(0, self.count)

    def samples(self) -> np.ndarray:
        """Byte of the high bits in which every 64th one stands, and the ones before that byte."""
        ones = np.bitwise_count(np.frombuffer(self.high, np.uint8)).astype(np.int64)
        before = np.cumsum(ones) - ones
        at = np.searchsorted(before, np.arange(0, self.count, _EVERY), side="right") - 1
        return np.stack([at, before[at]])

    def select(self, i: int, samples: np.ndarray) -> int:
        """Number i, from the sample before it: reads the bits between two samples."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        at, seen = (int(x) for x in samples[:, i // _EVERY])
        while (ones := self.high[at].bit_count()) + seen <= i:
            seen, at = seen + ones, at + 1
        byte = np.flatnonzero(np.unpackbits(np.frombuffer(self.high[at: at + 1], np.uint8)))
        place = 8 * at + int(byte[i - seen])
        return ((place - i) << self.bits) | int(self._lows(i, i + 1)[0])


def write(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 2, block_tokens: int = 1 << 20,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Ids of all texts, each followed by `end_id`, in ascending order of document id.

    Documents without id come first; rows that repeat an id stand side by side, ordered by
    text; a null text is empty. A part is one range of ids and is written by one task, block
    by block; a document is never cut, so a very long one makes its block longer. No rows
    give no blocks; other columns are not read.
    """

    def blocks(batches):
        code = encoder(tokenizer)
        width = 2 if max(code.vocabulary, end_id + 1) <= 1 << 16 else 4
        end, part = end_id.to_bytes(4, "little"), TaskContext.get().partitionId()
        block = first = size = 0
        keys, ids, ends = [], [], []

        def row():
            none = keys.count(None)
            known = np.array(keys[none:], np.int64)
            base = int(known[0]) if len(known) else 0
            key, bound = EliasFano.encode(known - base), EliasFano.encode(ends)
            flat = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes()
            one = (part, block, first, len(keys), size, width, flat, bound.low, bound.high, bound.bits,
                   none, base, key.low, key.high, key.bits)
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(one, _KINDS)], _NAMES)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = code.encode(text.as_py() or "") + end
                keys.append(key)
                ids.append(one)
                size += len(one) // 4
                ends.append(size)
                if size >= block_tokens:
                    yield row()
                    block, first, size = block + 1, first + size, 0
                    keys, ids, ends = [], [], []
        if keys:
            yield row()

    read = importable(docs).select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    ranged = read.repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(blocks, _BLOCK).write.parquet(path)


def documents_of(block: dict) -> Iterator[tuple]:
    """(doc_id, start within the part, ids as stored) of each document of a block."""
    ends = EliasFano(block["documents"], block["ends_low"], block["ends_high"], block["ends_bits"]).decode()
    known = block["documents"] - block["no_id"]
    keys = EliasFano(known, block["keys_low"], block["keys_high"], block["keys_bits"]).decode() + block["base"]
    names = [None] * block["no_id"] + keys.tolist()
    start, width = 0, block["width"]
    for name, end in zip(names, ends.tolist()):
        yield name, block["first"] + start, block["ids"][width * start: width * end]
        start = end


def _bases(stored: DataFrame) -> DataFrame:
    """(part, base): tokens before each part."""
    parts = stored.groupBy("part").agg(F.sum("tokens").alias("own"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("own").over(order), F.lit(0)).alias("base"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the files; `ids` as 32-bit.

    The tokens before a part come from the sums of the parts before it. There are as many
    parts as tasks wrote the files, so those sums are few and are broadcast.
    """
    stored = importable(spark.read.schema(_BLOCK).parquet(path))

    def unpack(batches):
        for batch in batches:
            for block in batch.to_pylist():
                rows = [(n, block["part"], s, len(i) // block["width"],
                         np.frombuffer(i, f"<u{block['width']}").astype("<u4").tobytes())
                        for n, s, i in documents_of(block)]
                names = [c.split()[0] for c in _ROWS.split(", ")]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return (
        stored.mapInArrow(unpack, _ROWS)
        .join(F.broadcast(_bases(stored)), "part")
        .select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")
    )


def places_of(block: dict, wanted: np.ndarray) -> Iterator[tuple]:
    """(doc_id, start within the part, tokens) of the documents of a block with the ids `wanted`.

    Ids are found by halving and boundaries taken by select, so that nothing is decoded but what
    lies between two samples. `wanted` is ascending, without repeats.
    """
    known = block["documents"] - block["no_id"]
    if not known:
        return
    keys = EliasFano(known, block["keys_low"], block["keys_high"], block["keys_bits"])
    ends = EliasFano(block["documents"], block["ends_low"], block["ends_high"], block["ends_bits"])
    of_keys, of_ends, base = keys.samples(), ends.samples(), block["base"]
    last = base + keys.select(known - 1, of_keys)
    for name in wanted[np.searchsorted(wanted, base): np.searchsorted(wanted, last, side="right")].tolist():
        i = bisect_left(range(known), name - base, key=lambda j: keys.select(j, of_keys))
        while i < known and keys.select(i, of_keys) == name - base:
            place = block["no_id"] + i
            start = ends.select(place - 1, of_ends) if place else 0
            yield name, block["first"] + start, ends.select(place, of_ends) - start
            i += 1


def offsets(spark: SparkSession, path: str, asked: Sequence[int]) -> DataFrame:
    """(doc_id, start, n_tokens) of the documents with the ids `asked`, as `read` gives them.

    Token ids are not read from the files, and boundaries are not decoded: `places_of` selects
    them. `asked` is a list of the caller, which every task gets. A repeated id gives all its
    documents, one that is not there none; documents without id cannot be asked for.
    """
    wanted = np.unique(np.array(asked, np.int64))
    columns = [c for c in _NAMES if c not in ("ids", "width", "block")]
    stored = importable(spark.read.schema(_BLOCK).parquet(path))

    def look(batches):
        for batch in batches:
            for block in batch.to_pylist():
                rows = [(name, block["part"], start, n) for name, start, n in places_of(block, wanted)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64(), pa.int32(), pa.int64(), pa.int64()])],
                        ["doc_id", "part", "start", "n_tokens"])

    found = stored.select(columns).mapInArrow(look, "doc_id bigint, part int, start bigint, n_tokens bigint")
    return found.join(F.broadcast(_bases(stored)), "part").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens")


def roundtrip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes the files to the shared folder and reads them back."""
    path = new_folder(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer, **options)
    return read(docs.sparkSession, path)
