"""Vectors as short codes: one codebook for each part of a vector, fitted by ball k-means.

The parts that share an entry are its ball. Two entries are neighbours if the radius of the
first ball reaches half way to the second: no other entry can be nearest to a part of the ball.
A part nearer to its entry than half the way to the closest neighbour lies in the stable core
and keeps its entry unseen; others lie in a ring, and only the neighbours within it are compared.
Components are whole numbers, so every comparison is exact, ties included.
"""

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import bounded, importable
from saldo.sources.scratch import settle

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Numbers held at once by the first assignment of a batch, and by the rings of one.
_AT_ONCE = 1 << 21
_ASSIGNED = "vec_id bigint, label string, v array<bigint>, code binary"


@dataclass(frozen=True)
class Codebooks:
    """`entries[part, entry]` are whole components; none where no vector was kept."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


@dataclass(frozen=True)
class Balls:
    """Neighbours of the entries of one part, those of an entry by rising distance.

    `near[i, :count[i]]` are the neighbours of entry i, `half[i]` the least squared distance
    from it at which each of them may be as near. `still` are the balls whose entry and
    neighbours have not moved: their parts keep their entry.
    """

    near: np.ndarray
    half: np.ndarray
    count: np.ndarray
    still: np.ndarray


def balls(entries: np.ndarray, before: np.ndarray, radii: np.ndarray) -> Balls:
    """Neighbours from the squared radii (-1 for empty balls)."""
    apart = ((entries[:, None] - entries[None]) ** 2).sum(-1)
    half = (apart + 3) // 4  # 4 d >= apart just where d >= half
    np.fill_diagonal(half, np.iinfo(np.int64).max)
    order = np.argsort(half, axis=1, kind="stable")
    half = np.take_along_axis(half, order, 1)
    count = (half <= radii[:, None]).sum(1)
    moved = (entries != before).any(1)
    reach = np.arange(len(entries))[None] < count[:, None]
    still = ~moved & ~(moved[order] & reach).any(1)
    return Balls(order, half, count, still)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(-1)


def nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each row, the first of equals, by comparing all."""
    out = np.empty(len(x), np.int64)
    step = max(1, _AT_ONCE // max(entries.size, 1))
    for at in range(0, len(x), step):
        out[at: at + step] = _squared(x[at: at + step, None], entries[None]).argmin(1)
    return out


def renearest(x: np.ndarray, home: np.ndarray, entries: np.ndarray, ball: Balls) -> np.ndarray:
    """The same from the former entry of each row: only what its ring holds is compared."""
    rows = np.flatnonzero(~ball.still[home])
    own = _squared(x[rows], entries[home[rows]])
    ring = np.zeros(len(rows), np.int64)
    for entry in np.unique(home[rows]):
        mine = home[rows] == entry
        ring[mine] = np.searchsorted(ball.half[entry, : ball.count[entry]], own[mine], "right")
    keep = ring > 0
    rows, own, ring = rows[keep], own[keep], ring[keep]
    out = home.copy()
    ends = np.cumsum(ring)
    at = 0
    while at < len(rows):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + _AT_ONCE // max(x.shape[1], 1), "right")))
        mine, n = rows[at:to], ring[at:to]
        starts = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(starts, n)
        rival = ball.near[np.repeat(home[mine], n), place]
        far = _squared(np.repeat(x[mine], n, axis=0), entries[rival])
        best = np.minimum.reduceat(far, starts)
        first = np.minimum.reduceat(np.where(far == np.repeat(best, n), rival, len(entries)), starts)
        wins = (best < own[at:to]) | ((best == own[at:to]) & (first < home[mine]))
        out[mine] = np.where(wins, first, home[mine])
        at = to
    return out


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str | None = "label") -> DataFrame:
    """(vec_id, label, v): components as floor(256 x); vectors with a null or non-finite one are left out."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    limit = F.sqrt(F.lit(2.0**59) / F.greatest(F.size(vector), F.lit(1)))
    scaled = F.transform(vector, lambda x: F.when(F.abs(x) * SCALE < limit, F.floor(x * SCALE)).otherwise(
        F.raise_error(F.concat(F.lit("component too large for exact distances: "), x.cast("string"))).cast("bigint")))
    label = F.col(f"`{label_col}`") if label_col else F.lit(None)
    return df.filter(fine).select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), label.cast("string").alias("label"), scaled.alias("v"))


def _seeds(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The vectors of the smallest ids, part by part: (parts, entries, width)."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()
    return np.array([r.v for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), parts, -1)


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), parts).astype(np.int64)


def _assigned(vectors: DataFrame, entries: np.ndarray, near: list[Balls] | None) -> DataFrame:
    """`vectors` with the entry of each part in `code`; from their former codes if `near` is given."""
    parts = len(entries)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2), parts)
            home = _codes(batch.column(3), parts) if near else None
            code = np.stack([renearest(x[:, p], home[:, p], entries[p], near[p]) if near else nearest(x[:, p], entries[p])
                             for p in range(parts)], 1)
            packed = pa.array([row.tobytes() for row in code.astype("<u2")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), packed], ["vec_id", "label", "v", "code"])

    return importable(vectors).mapInArrow(assign, _ASSIGNED)


def _folded(assigned: DataFrame, entries: np.ndarray, measure: bool) -> DataFrame:
    """(part, entry, n, sums, radius) of each ball: by task first, then over all.

    `sums` of the components, or with `measure` the squared radius about `entries` instead.
    """
    parts, k, width = entries.shape

    def fold(batches):
        n, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        radius = np.full((parts, k), -1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, code = _matrix(batch.column(0), parts), _codes(batch.column(1), parts)
            for p in range(parts):
                if measure:
                    np.maximum.at(radius[p], code[:, p], _squared(x[:, p], entries[p][code[:, p]]))
                else:
                    n[p] += np.bincount(code[:, p], minlength=k)
                    np.add.at(sums[p], code[:, p], x[:, p])
        p, e = np.nonzero(radius >= 0 if measure else n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64())),
             pa.array(radius[p, e])], ["part", "entry", "n", "sums", "radius"])

    by_task = importable(assigned).select("v", "code").mapInArrow(
        fold, "part int, entry int, n bigint, sums array<bigint>, radius bigint")
    if measure:
        return by_task.groupBy("part", "entry").agg(F.max("radius").alias("radius"))
    # A sum over all may pass 64 bits, that of a task cannot.
    total = [F.sum(F.get("sums", i).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    return by_task.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total)


def _moved(assigned: DataFrame, entries: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floor of the mean of its parts; unused ones stay."""
    out = entries.copy()
    for r in _folded(assigned, entries, False).collect():  # one row a part and entry
        out[r.part, r.entry] = [int(r[f"s{i}"]) // r.n for i in range(entries.shape[2])]
    return out


def _balls(assigned: DataFrame, entries: np.ndarray, before: np.ndarray) -> list[Balls]:
    radii = np.full(entries.shape[:2], -1, np.int64)
    for r in _folded(assigned, entries, True).collect():  # one row a part and entry
        radii[r.part, r.entry] = r.radius
    return [balls(entries[p], before[p], radii[p]) for p in range(len(entries))]


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, codes, error) of each kept vector, and the codebooks.

    `codes` has the entry of each part, `error` is the squared distance to the entries.
    Vectors that are null, empty, or hold a null or non-finite component are left out. All have
    the length of the kept vector of the smallest id, which `parts` must divide; others are left
    out too. Rows that repeat an id are vectors of their own; those without id come last among
    the seeds. With fewer vectors than `entries`, each is an entry. No vectors give no rows and
    empty codebooks. Components so large that a distance could pass 64 bits are an error.
    Labels come back as text. Extra columns are not read.
    """
    vectors = settle(whole_vectors(df, id_col, vector_col, label_col), "vectors")
    sized = vectors.filter((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = sized.orderBy(F.asc_nulls_last("vec_id"), "v").limit(1).collect()
    if not first:
        none = sized.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("bigint").alias("error"))
        return none, Codebooks(np.zeros((parts, 0, 1), np.int64))
    vectors = sized.filter(F.size("v") == len(first[0].v))
    books = _seeds(vectors, parts, entries)
    near = None
    for _ in range(rounds):
        vectors = settle(_assigned(vectors, books, near), "assigned")
        before, books = books, _moved(vectors, books)
        near = _balls(vectors, books, before)
    return _measured(_assigned(vectors, books, near), books), Codebooks(books)


def _measured(assigned: DataFrame, books: np.ndarray) -> DataFrame:
    parts = len(books)

    def measure(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, code = _matrix(batch.column(2), parts), _codes(batch.column(3), parts)
            error = sum(_squared(x[:, p], books[p][code[:, p]]) for p in range(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(code.astype(np.int32)), pa.list_(pa.int32())), pa.array(error)],
                ["vec_id", "label", "codes", "error"])

    return assigned.mapInArrow(measure, "vec_id bigint, label string, codes array<int>, error bigint")


def label_errors(coded: DataFrame) -> DataFrame:
    """`coded`, a settled frame, with label_error: the error summed over rows of equal labels, nulls together.

    The sums are made by task first, so one label may have a third of all rows.
    """
    sums = settle(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = bounded(sums.withColumnRenamed("label", "_label"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def hex_code(codes: Column) -> Column:
    """Two hex digits for each part."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 2, "0")), ""))
