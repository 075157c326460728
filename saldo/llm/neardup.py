"""Near duplicates by bottom-k sketches from one hash function.

The hash of a word shingle is a 64-bit number. Its range is cut into equal strips, and of each
strip a document retains its smallest hashes. Inverted lists of what is retained bring together
documents that may be alike; an estimate from the union of two sketches drops pairs that are
not; the full shingle sets decide.

A list is not keyed by one retained hash, as every document with a frequent shingle would be on
it, but by the run of up to `RUN` hashes that a strip retains. Two documents of similarity 0.8
share the run of a strip with probability 0.8**4, that of no strip of 32 with 5e-8. Small
documents use fewer strips, so that a run holds several hashes, and the smallest are keyed by
their sets less up to two shingles, which misses none.

Links are needed only to tell which documents hang together. Each member of a list is first
compared with the smallest member. Members of a list that are then in different components are
compared with one another, those of large components or of long lists block by block. So
copies in thousands make no pairs in millions, yet no pair of a list is left undecided.
"""

from bisect import bisect_left
from collections.abc import Callable
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import bounded, importable, without
from saldo.llm.components import components
from saldo.sources.scratch import settle

SIMILAR = 80  # percent
RUN = 4
SKETCH = 32
#: Strips -> set sizes they serve. Documents near a border are listed under both.
_STRIPS = {8: (10, 24), 16: (24, 52), 32: (52, 1 << 62)}
_SMALL = 9  # up to here two sets of similarity 0.8 differ by two shingles at most
#: Of 32 hashes of a union at similarity 0.8, 25.6 are in both sets, under 13 in 2e-7 of cases.
_SKETCH_LEAST = 13
#: Of the 64 bits of two signatures 57.6 or more agree at 0.8, under 44 in 5e-7 of cases.
_BITS_LEAST = 44
#: Components of so many documents are compared as a whole, in blocks of rows of each side.
_LARGE, _BLOCK = 64, 512

_SKETCHED = ("doc_id bigint, n_shingles bigint, same binary, bits bigint, "
             "sketch array<bigint>, lists array<bigint>")


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Hashes of the distinct shingles, ascending. Words end at ASCII white space, A-Z count as a-z.

    Fewer words than a shingle has make one shingle; no words make none.
    """
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    n = min(words, len(w))
    code = xxhash.xxh3_64_intdigest
    if n == 2:
        found = {code(a + b" " + b) for a, b in zip(w, w[1:])}
    else:
        found = {code(b" ".join(w[i: i + n])) for i in range(len(w) - n + 1)}
    out = np.fromiter(found, np.uint64, len(found))
    out.sort()
    return out


def _keys(hashes: np.ndarray) -> list[int]:
    """Keys of the inverted lists of one document."""
    n, code, out = len(hashes), xxhash.xxh3_64_intdigest, []
    if n * 4 <= (_SMALL * 5):
        whole = hashes.tolist()
        for gone in range(min(3, n)):
            for rest in combinations(whole, n - gone):
                out.append(code(np.array(rest, np.uint64).tobytes(), 1))
    for strips, (least, most) in _STRIPS.items():
        if n * 5 < least * 4 or n * 4 > most * 5:
            continue
        values, step = hashes.tolist(), (1 << 64) // strips
        begin = 0
        for s in range(strips):
            end = bisect_left(values, (s + 1) * step, begin) if s < strips - 1 else n
            if end > begin:
                out.append(code(hashes[begin: min(end, begin + RUN)].tobytes(), strips * 64 + s))
            begin = end
    return out


def _bits(hashes: np.ndarray) -> int:
    """One bit of the smallest hash of each of 64 strips."""
    strip = (hashes >> np.uint64(58)).astype(np.int64)
    first = np.flatnonzero(np.diff(strip, prepend=-1))
    ones = (hashes[first] >> np.uint64(7)) & np.uint64(1)
    return int(np.bitwise_or.reduce(ones << strip[first].astype(np.uint64))) if len(first) else 0


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def sketches(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: set size, digest of the set, 64 signature bits, bottom-k sketch, list keys."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [c.split()[0] for c in _SKETCHED.split(", ")]

    def sketch(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = shingle_set(text.as_py(), words)
                same = xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None
                keys = [_signed(k) for k in dict.fromkeys(_keys(h))] if doc is not None else []
                rows.append((doc, len(h), same, _signed(_bits(h)), h[:SKETCH].view(np.int64).tolist(), keys))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    read = importable(docs).select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))
    return read.mapInArrow(sketch, _SKETCHED)


def _full_sets(docs: DataFrame, asked: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(node, hashes): the whole shingle sets of `asked` (node, first, same), once each."""

    def sets(batches):
        for batch in batches:
            rows = []
            for node, same, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                h = shingle_set(text, words)
                # Another row may have the id of the one that is asked for.
                if xxhash.xxh3_128_digest(h.tobytes()) == same:
                    rows.append((node, h.view(np.int64)))
            if rows:
                n, h = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n, pa.int64()), pa.array(h, pa.list_(pa.int64()))], ["node", "hashes"])

    read = importable(docs).select(F.col(f"`{id_col}`").cast("bigint").alias("first"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    found = read.join(bounded(asked), "first").select("node", "same", "text")
    return found.mapInArrow(sets, "node bigint, hashes array<bigint>").groupBy("node").agg(
        F.first("hashes").alias("hashes"))


def _near_size(a: Column, b: Column) -> Column:
    return (100 * F.least(a, b)) >= (SIMILAR * F.greatest(a, b))


def _may_link(a: str, b: str) -> Column:
    """What sizes and signatures leave possible."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    agree = 64 - F.bit_count(F.col(f"{a}.bits").bitwiseXOR(F.col(f"{b}.bits")))
    return _near_size(n, m) & (agree >= _BITS_LEAST)


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, id_col: str,
           text_col: str) -> DataFrame:
    """Of settled pairs (a, b) those of similarity 0.8 or more, by sketch and then by full set."""
    if pairs.isEmpty():
        return pairs
    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("of_a"),
                        F.col("n_shingles").alias("n_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("of_b"),
                         F.col("n_shingles").alias("n_b"))
    union = F.slice(F.array_sort(F.array_union("of_a", "of_b"), _unsigned), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect("of_a", "of_b")))
    # A union of fewer hashes than a sketch holds is the whole union.
    likely = both * 100 >= F.when(F.size(union) < SKETCH, SIMILAR * F.size(union)).otherwise(
        100 * _SKETCH_LEAST)
    close = settle(pairs.join(left, "a").join(right, "b").filter(_near_size(F.col("n_a"), F.col("n_b")))
                   .filter(likely).select("a", "b"), "likely-pairs")
    asked = close.select(F.col("a").alias("node")).union(close.select("b")).distinct()
    asked = settle(nodes.select("node", "first", "same").join(asked, "node", "left_semi"), "asked")
    sets = _full_sets(docs, asked, words, id_col, text_col)
    of_b = close.join(sets.withColumnsRenamed({"node": "b", "hashes": "in_b"}), "b")
    full = of_b.join(sets.withColumnsRenamed({"node": "a", "hashes": "in_a"}), "a")
    shared = F.size(F.array_intersect("in_a", "in_b"))
    total = F.size("in_a") + F.size("in_b")
    counted = full.select("a", "b", shared.alias("shared"), total.alias("total"))
    return settle(counted.filter(100 * F.col("shared") >= SIMILAR * (F.col("total") - F.col("shared")))
                  .select("a", "b"), "links")


def _unsigned(a: Column, b: Column) -> Column:
    """Order of the hashes as they were sketched: those with the top bit last."""
    flip = F.lit(-(1 << 63)).cast("bigint")
    x, y = a.bitwiseXOR(flip), b.bitwiseXOR(flip)
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def classes(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of `docs`.

    A component is all that links reach, named by its smallest id, whose row is kept. Equal
    sets are linked, whatever the texts. Documents without words link with nothing and are
    kept, as are rows without id, whose component is null. Rows that repeat an id with another
    text are documents of their own. No rows give no rows; other columns are not read.
    """
    rows = settle(sketches(docs, words, id_col, text_col), "sketches")
    # Equal sets first: one node stands for all its copies, however many. Nodes are numbered
    # as they are written, and read from there only.
    own = F.struct("n_shingles", "bits", "sketch", "lists")
    nodes = settle(
        rows.filter(F.col("doc_id").isNotNull() & F.col("same").isNotNull())
        .groupBy("same").agg(F.min("doc_id").alias("first"), F.min_by(own, "doc_id").alias("own"))
        .select(F.monotonically_increasing_id().alias("node"), "same", "first", "own.*"), "nodes")
    listed = nodes.select("node", "n_shingles", "bits", F.explode("lists").alias("key"))
    heads = listed.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("members"))
    lists = settle(listed.join(heads.filter("members > 1"), "key")
                   .select("key", "node", "n_shingles", "bits", "head"), "lists")
    stars = (lists.filter(F.col("node") != F.col("head"))
             .select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    links = _links(settle(stars, "stars"), nodes, docs, words, id_col, text_col)
    labels = components(links)
    more = _between(lists, labels, nodes, docs, words, id_col, text_col)
    if more:
        labels = components(settle(reduce(DataFrame.union, more, links), "all-links"))
    labelled = nodes.join(labels, "node", "left").select(
        "same", "first", F.coalesce("label", "node").alias("label"))
    names = labelled.groupBy("label").agg(F.min("first").alias("component"))
    per_set = settle(labelled.join(names, "label").select("same", "component"), "components")
    component = F.when(F.col("same").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(
        F.col("component"))
    return rows.join(per_set, "same", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _between(lists: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, id_col: str,
             text_col: str) -> list[DataFrame]:
    """Links (a, b) between members of a list in different components, of each way of comparing.

    A way that has nothing to compare runs no jobs.
    """
    still = _open(lists, labels)
    if still.isEmpty():
        return []
    sizes = labels.groupBy("label").count().filter(F.col("count") >= _LARGE)
    large = settle(sizes.select(F.col("label").alias("large"), F.col("count").alias("members")), "large")
    small = still.join(bounded(large), F.col("label") == F.col("large"), "left_anti")
    per_list = small.groupBy("key").count().filter(F.col("count") >= _LARGE)
    wide = settle(per_list.select("key", F.ceil(F.col("count") / _BLOCK).cast("int").alias("blocks")), "wide")
    found = [_links(_in_narrow(small, wide), nodes, docs, words, id_col, text_col)]
    if not wide.isEmpty():
        found.append(_in_wide(small, wide, nodes, docs, words, id_col, text_col))
    if not large.isEmpty():
        found.append(_to_large(still, labels, large, nodes, docs, words, id_col, text_col))
    return found


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the lists that have more than one component."""
    label = F.coalesce("label", "node").alias("label")
    spread = (lists.select("key", "node").join(labels, "node", "left").select("key", label)
              .groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")))
    still = settle(spread.filter("low < high").select("key"), "open-lists")
    members = lists.join(bounded(still), "key", "left_semi").join(labels, "node", "left")
    return settle(members.select("key", "node", "n_shingles", "bits", label), "open-members")


def _in_narrow(small: DataFrame, wide: DataFrame) -> DataFrame:
    """Pairs of a list that is not wide, in different components, that may be alike."""
    narrow = small.join(bounded(wide), "key", "left_anti")
    pairs = narrow.alias("a").join(narrow.alias("b"), (
        (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.label") != F.col("b.label")) & _may_link("a", "b")))
    return settle(pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), "small-pairs")


def _in_wide(small: DataFrame, wide: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, id_col: str,
             text_col: str) -> DataFrame:
    """Links (a, b) between the members of each wide list (key, blocks).

    The members are dealt to blocks, and each two blocks are compared by an inverted index. Only
    links that join what is not joined yet leave a task, fewer than it has members.
    """
    members = settle(small.select("key", "node", "label").join(bounded(wide), "key"), "wide-members")
    asked = settle(nodes.select("node", "first", "same").join(
        members.select("node").distinct(), "node", "left_semi"), "asked")
    sets = settle(_full_sets(docs, asked, words, id_col, text_col), "sets")
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    dealt = members.join(sets, "node").select("key", "node", "label", "hashes", "blocks", own.alias("block")).select(
        "key", "node", "label", "hashes", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = dealt.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                         "node", "label", "hashes", "block")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        left, right = (rows[rows["block"] == block] for block in key[1:])
        found, root = [], {label: label for label in rows["label"]}

        def top(label: int) -> int:
            while root[label] != label:
                root[label] = label = root[root[label]]
            return label

        if len(left) and len(right):
            alike = _matcher(left["hashes"].to_numpy())
            names, labels = left["node"].to_numpy(), left["label"].to_numpy()
            for node, label, hashes in zip(right["node"], right["label"], right["hashes"]):
                for i in alike(hashes):
                    a, b = top(labels[i]), top(label)
                    if a != b:
                        root[a] = b
                        found.append((node, names[i]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return settle(cells.groupBy("key", "low", "high").applyInPandas(compare, "a bigint, b bigint"), "wide-links")


def _matcher(sets: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """For a set, the places of those of `sets` that are alike, by an index of their hashes."""
    sizes = np.array([len(h) for h in sets])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]

    def alike(own: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
        hit = np.flatnonzero(high > low)
        counts = (high - low)[hit]
        places = np.repeat(low[hit] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        shared = np.bincount(owner[places], minlength=len(sizes))
        return np.flatnonzero((shared > 0) & (100 * shared >= SIMILAR * (sizes + len(own) - shared)))

    return alike


def _to_large(still: DataFrame, labels: DataFrame, large: DataFrame, nodes: DataFrame, docs: DataFrame,
              words: int, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) of documents with large components beside which they stand in some list.

    Each such document is compared with all members of the component, by counting shared
    hashes over an inverted index of a block of members. Blocks bound what a task holds, and
    only links leave it, at most one for each document and block.
    """
    in_list = still.join(bounded(large), F.col("label") == F.col("large")).groupBy("key").agg(
        F.collect_set("large").alias("beside"))
    beside = still.join(in_list, "key").groupBy("node", "label").agg(
        F.array_distinct(F.flatten(F.collect_set("beside"))).alias("beside"))
    outside = beside.select("node", "label", F.explode("beside").alias("large")).filter("label != large")
    outside = settle(outside.select("node", "large"), "outside")
    inside = labels.withColumnRenamed("label", "large").join(
        bounded(outside.select("large").distinct()), "large", "left_semi")
    asked = settle(nodes.select("node", "first", "same").join(
        outside.select("node").union(inside.select("node")).distinct(), "node", "left_semi"), "asked")
    sets = settle(_full_sets(docs, asked, words, id_col, text_col), "sets")
    of_out = outside.groupBy("large").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("out_blocks"))
    blocks = settle(large.join(of_out, "large").withColumn(
        "in_blocks", F.ceil(F.col("members") / _BLOCK).cast("int")), "blocks")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("node"), own).cast("int").alias(own)
        return rows.join(bounded(blocks), "large").join(sets, "node").select(
            "large", "node", "hashes", mine, F.col(other).alias("_n")).select(
            *[F.col(c).alias(c) for c in ("large", "node", "hashes", own)],  # new columns for each side
            F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias(other))

    def compare(members: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(members) and len(others):
            alike = _matcher(members["hashes"].to_numpy())
            for node, own in zip(others["node"], others["hashes"]):
                places = alike(own)
                if len(places):
                    found.append((node, members["node"].iloc[places[0]]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    keys = ["large", "in_blocks", "out_blocks"]
    left = dealt(inside, "in_blocks", "out_blocks").groupBy(*keys)
    right = dealt(outside, "out_blocks", "in_blocks").groupBy(*keys)
    return settle(left.cogroup(right).applyInPandas(compare, "a bigint, b bigint"), "large-links")


def deduplicate(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` less all but one document of each component."""
    decided = classes(docs, words, id_col, text_col)
    gone = decided.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept").select("doc_id")
    return without(docs, settle(gone, "near-duplicates"), id_col)
