"""Phrases whose words keep company, counted through prefix-free parsing.

Texts are cut into chunks by their content: a pair of words whose hash is a multiple of a number
ends a chunk and begins the next, so that chunks overlap by the words a phrase can reach beyond
its first. Equal passages give equal chunks wherever they stand. Each distinct chunk is counted
inside once, times the number of its places; a phrase belongs to the chunk that owns its first
word, so what overlaps is counted once.

Lengths are counted one after the other. A phrase can be frequent only if its first words and
its last words are, which a bitmap of bounded size tells, with errors on the safe side.

Tasks work on columns: words are numbered within a block of rows, phrases are rows of numbers.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import bounded, importable
from saldo.sources.scratch import settle

LONGEST, LEAST, TOP = 3, 10, 2000
#: About every so many words a chunk ends.
SPACING = 8
#: Bits for each frequent phrase, and for all of them at most (16 MB); beyond, less is spared.
_BITS_EACH, _BITS = 16, 1 << 27
_BUCKET = 1 << 15  # bits of one of Spark's bitmaps
#: Bytes of text that a task works on at once; a longer text is a block of its own.
_BLOCK = 8 << 20
#: Groups in which the best of a language are found before they meet.
_SALTS = 32
UNKNOWN = "und"
#: A phrase is hashed by its words: odd factors, small enough for sums of 32-bit hashes in 63 bits.
_FACTORS = tuple((0x9E3779B9 * (2 * i + 3) | 1) & 0xFFFFFFF for i in range(8))

_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = range(0x61, 0x7B)
_TABLE[0x09] = 0x20
for _mark in b".,;:!?\x0A\x0B\x0C\x0D":
    _TABLE[_mark] = 0x0A
_TABLE = bytes(_TABLE)


@dataclass
class Words:
    """Words of a block in order: their number in `distinct`, and the row of the block each is in."""

    distinct: pa.Array
    number: np.ndarray
    row: np.ndarray
    piece: np.ndarray

    @property
    def hashes(self) -> np.ndarray:
        """crc32 of the distinct words."""
        return np.fromiter(map(crc32, self.distinct.to_pylist()), np.int64, len(self.distinct))


def words_of(texts: list[bytes]) -> Words:
    """Words of lower-cased texts whose pieces are lines and whose words are parted by blanks."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    line = data == 0x0A
    letter = ~line & (data != 0x20)
    edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[letter].tobytes())])
    coded = packed.dictionary_encode()
    first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    return Words(coded.dictionary, coded.indices.to_numpy().astype(np.int64),
                 np.searchsorted(first, starts, "right") - 1, np.cumsum(line)[starts] if len(starts) else starts)


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """The rows of the batches in blocks of about `_BLOCK` bytes of a column."""
    held, size = [], 0
    for batch in batches:
        at = 0
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)) if batch.num_rows else []
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + _BLOCK - size, "right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1] - before)
            at = to
            if size >= _BLOCK:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the members of spans, one span after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def chunks(texts: list[bytes], longest: int = LONGEST, spacing: int = SPACING) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(chunk, words it owns, row of its text) of the texts; chunks of a piece share `longest` - 1 words."""
    w = words_of([t.translate(_TABLE) for t in texts])
    n, beyond = len(w.number), longest - 1
    if not n:
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(n)
    opens = np.append(True, w.piece[1:] != w.piece[:-1])
    piece_starts = np.flatnonzero(opens)
    end = np.repeat(np.append(piece_starts[1:], n), np.diff(np.append(piece_starts, n)))  # of the piece of each word
    h = w.hashes[w.number]
    trigger = (h * 31 + np.append(h[1:], 0)) % spacing == 0
    starts = np.flatnonzero(opens | (trigger & (place + beyond < end)))
    nexts = np.append(starts[1:], n)
    own = nexts - starts
    length = np.minimum(nexts + beyond, end[starts]) - starts
    members = w.distinct.take(pa.array(w.number[_spans(starts, length)]))
    offsets = pa.array(np.append(0, np.cumsum(length)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, members), b" "), own, w.row[starts]


def _summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct key, and the sum of `n` over its places; keys are whole numbers from 0."""
    key = keys[0]
    for more in keys[1:]:
        wide = int(more.max()) + 1 if len(more) else 1
        key = np.unique(key, return_inverse=True)[1] * wide + more
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(key) else np.zeros(0, np.int64)
    return order[first], np.add.reduceat(n[order], first) if len(key) else n


def dictionary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
               spacing: int = SPACING) -> DataFrame:
    """(lang, chunk, own, n): distinct chunks, the words each owns and the number of its places."""

    def parse(batches):
        for block in _blocks(batches, 1):
            found, own, row = chunks(block.column(1).to_pylist(), longest, spacing)
            langs = block.column(0).combine_chunks().dictionary_encode()
            coded = found.dictionary_encode()
            at, n = _summed([coded.indices.to_numpy().astype(np.int64), langs.indices.to_numpy()[row].astype(np.int64), own],
                            np.ones(len(own), np.int64))
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(langs.indices.take(pa.array(row[at]))), found.take(pa.array(at)),
                 pa.array(own[at], pa.int32()), pa.array(n)], ["lang", "chunk", "own", "n"])

    text = F.col(f"`{text_col}`").cast("string")
    read = importable(docs).filter(text.isNotNull()).select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), text.cast("binary").alias("text"))
    parsed = read.mapInArrow(parse, "lang string, chunk binary, own int, n bigint")
    return parsed.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))


class Bitmap:
    """The phrases of one length that may be frequent: all that are, and a few others."""

    def __init__(self, bits: int, filled: bytes):
        self._mask, self._filled = bits - 1, filled

    def test(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self._mask
        filled = np.frombuffer(self._filled, np.uint8)
        return (filled[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def phrase_hash(lang: Column, phrase: Column) -> Column:
    """Sum of the hashes of language and words, each times its factor; tasks compute the same."""
    hashed = F.transform(F.split(phrase, " "), lambda w, i: F.crc32(w) * F.get(F.array(*map(F.lit, _FACTORS[1:])), i))
    return F.crc32(lang) * _FACTORS[0] + F.aggregate(hashed, F.lit(0).cast("bigint"), lambda a, b: a + b)


def bitmap(frequent: DataFrame, most: int = _BITS) -> Bitmap:
    """Of a settled frame with lang and phrase. Reads back `most` bits at most."""
    bits = _BUCKET
    wanted = frequent.count() * _BITS_EACH
    while bits < min(wanted, most):
        bits *= 2
    # Spark's bitmaps count places from 1.
    place = phrase_hash(F.col("lang"), F.col("phrase")).bitwiseAND(F.lit(bits - 1)) + 1
    rows = frequent.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("filled")).collect()
    filled = np.zeros(bits // 8, np.uint8)
    for r in rows:
        at = (r.bucket - 1) * (_BUCKET // 8)
        filled[at: at + len(r.filled)] = np.frombuffer(bytes(r.filled), np.uint8)
    return Bitmap(bits, filled.tobytes())


def _counts(block: pa.Table, size: int, shorter: Bitmap | None) -> pa.RecordBatch:
    """(lang, phrase, n) of the phrases of `size` words that chunks own and that may be frequent."""
    w = words_of(block.column(1).to_pylist())
    own, n = block.column(2).to_numpy(), block.column(3).to_numpy()
    langs = block.column(0).combine_chunks().dictionary_encode()
    lang = langs.indices.to_numpy().astype(np.int64)[w.row]
    opens = np.flatnonzero(np.append(True, w.row[1:] != w.row[:-1]))
    length = np.diff(np.append(opens, len(w.row)))
    place = np.arange(len(w.row)) - np.repeat(opens, length)
    at = np.flatnonzero((place < own[w.row]) & (place + size <= np.repeat(length, length)))
    if shorter:
        h = w.hashes[w.number]
        of_lang = np.array([crc32(x.encode()) for x in langs.dictionary.to_pylist()], np.int64)[lang] * _FACTORS[0]
        for skip in (0, 1):  # the phrase less its last word, then less its first
            hashed = of_lang[at] + sum(h[at + skip + i] * _FACTORS[1 + i] for i in range(size - 1))
            at = at[shorter.test(hashed)]
    place, total = _summed([lang[at], *(w.number[at + i] for i in range(size))], n[w.row[at]])
    at = at[place]
    words = [w.distinct.take(pa.array(w.number[at + i])) for i in range(size)]
    phrase = pc.binary_join_element_wise(*words, b" ") if size > 1 else words[0]
    return pa.RecordBatch.from_arrays(
        [langs.dictionary.take(pa.array(lang[at])), phrase, pa.array(total)], ["lang", "phrase", "n"])


def counted(parsed: DataFrame, size: int, shorter: Bitmap | None, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f), settled: phrases of `size` words with at least `least` places."""
    shared = parsed.sparkSession.sparkContext.broadcast(shorter)  # at most `_BITS`

    def count(batches):
        for block in _blocks(batches, 1):
            yield _counts(block, size, shared.value)

    places = importable(parsed).select("lang", "chunk", "own", "n").mapInArrow(count, "lang string, phrase binary, n bigint")
    found = places.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    found = settle(found.select("lang", F.col("phrase").cast("string").alias("phrase"), "f"), f"phrases-{size}")
    shared.destroy()
    return found


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact for counts of up to 16 digits."""
    wide = [c.cast("decimal(38,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(38,0)"), wide[1] * wide[2])


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
                 least: int = LEAST, top: int = TOP, share: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    A null language is `und`, a null text is empty; rows that repeat count each time. Phrases of
    2 to `longest` words with at least `least` places are candidates; those inside a longer
    candidate with `share` percent of their places go. Languages without a candidate, and empty
    tables, give no rows. Other columns are not read.
    """
    parsed = settle(dictionary(docs, lang_col, text_col, longest), "chunks")
    by_size = [counted(parsed, 1, None, least)]
    for size in range(2, longest + 1):
        by_size.append(counted(parsed, size, bitmap(by_size[-1]), least))
    known = by_size[0]
    for one in by_size[1:]:
        known = known.unionByName(one)
    candidates = by_size[1]
    for one in by_size[2:]:
        candidates = candidates.unionByName(one)
    words = F.split("phrase", " ")
    candidates = candidates.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"))

    def part(of: Column, start, length) -> Column:
        return F.array_join(F.slice(of, start, length), " ")

    cut = candidates.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.struct(
            k.alias("k"), part(F.col("w"), F.lit(1), k).alias("left"), part(F.col("w"), k + 1, F.size("w") - k).alias("right")))).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut.*")
    for side, count in (("left", "l"), ("right", "r")):
        cut = cut.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    scored = cut.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("low"))
    # The places of the most frequent longer candidate around each phrase.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: part(F.col("w"), i, n))))
    around = candidates.filter(F.size("w") > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longer"))
    total = bounded(settle(parsed.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n")), "words"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    flat = kept.select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may have most of the phrases: the best of its parts meet, not all of them.
    part_of = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).orderBy(*order)
    best = flat.withColumn("_place", F.row_number().over(part_of)).filter(F.col("_place") <= top).drop("_place")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
