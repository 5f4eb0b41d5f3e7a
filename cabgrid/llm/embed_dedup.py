"""Embedding near-duplicates by a join of packed blocks.

Vectors are put on a grid over the two leading axes of their second moments,
with cells at least as wide as the distance that the cosine allows, and packed
into blocks of one cell and a bounded size. Blocks of one cell or of two
neighbouring ones are compared pair by pair: a single-precision product finds
what may be linked, and the cosine of every pair found is then computed from
the vectors themselves. A task reads two partitions of blocks where they are
written, so no vector is shuffled or copied for the vectors it is compared
with: the work grows with the square of the table, disk and memory do not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabgrid.llm.common import checkpointed, components, forest

#: Vectors of a block; a cell has as many blocks as it needs.
TILE = 4096
#: Bytes of a block's vectors at most, and of those of a partition of blocks.
BLOCK, PARTITION = 1 << 24, 1 << 26
#: Rounding may not lose a pair: cells are wider by so much.
SLACK = 1e-6
#: Cells are so wide at least, however near linked vectors are: narrow ones would hold few vectors each.
LEAST_WIDTH = 0.2
_CHUNK = 512


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Lists as rows of doubles, padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), size))
    out[np.arange(size) < lengths[:, None]] = values
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(classes: DataFrame, size: int) -> np.ndarray:
    """Second moments of the unit vectors: size * size sums reach the driver, however many vectors there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            if b.num_rows:
                u = _unit(_matrix(b.column("vector"), size))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], ["at", "part"])

    sums = classes.select("vector").mapInArrow(run, "at bigint, part double").groupBy("at").agg(F.sum("part").alias("part"))
    out = np.zeros(size * size)
    for row in sums.collect():
        out[row["at"]] = row["part"]
    return out.reshape(size, size)


def _blocks(classes: DataFrame, moments: np.ndarray, cosine: float) -> DataFrame:
    """Classes packed into blocks of one length and cell: ``dim``, ``x``, ``y``, and ``ks``, ``ns``, ``data`` as bytes."""
    size = len(moments)
    tile = max(1, min(TILE, BLOCK // (8 * size)))
    axes = np.linalg.eigh(moments)[1][:, ::-1][:, :2]
    width = max(np.sqrt(max(2 - 2 * cosine, 0.0) + SLACK), LEAST_WIDTH)
    names = ["dim", "x", "y", "ks", "ns", "data"]

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        column = t.column("vector").chunk(0)
        k, n, dim = t.column("k").to_numpy(), t.column("n").to_numpy(), np.diff(column.offsets.to_numpy())
        starts = column.offsets.to_numpy() - column.offsets[0].as_py()
        values = column.flatten().to_numpy(zero_copy_only=False)
        cell = np.zeros((len(k), 2), np.int32)
        for s in range(0, len(k), tile):
            place = _unit(_matrix(column.slice(s, tile), size)) @ axes
            cell[s : s + tile, : place.shape[1]] = np.floor(place / width)
        order = np.lexsort((cell[:, 1], cell[:, 0], dim))
        keys = np.stack([dim, cell[:, 0], cell[:, 1]])[:, order]
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for s, e in zip([0, *cuts], [*cuts, len(order)]):
            for a in range(s, e, tile):
                rows = order[a : min(a + tile, e)]
                at = starts[rows][:, None] + np.arange(dim[rows[0]])
                made = [*(pa.array([int(x)], pa.int32()) for x in keys[:, a]), *(pa.array([x.tobytes()], pa.binary()) for x in (k[rows], n[rows], values[at]))]
                yield pa.RecordBatch.from_arrays(made, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= 8 * tile:
                yield from packed(held)
                held, n = [], 0
        if held:
            yield from packed(held)

    return classes.select("k", "n", "vector").mapInArrow(run, "dim int, x int, y int, ks binary, ns binary, data binary")


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """Each pair of blocks that may hold linked vectors, once, a block with itself included (``alone``).

    The join is told to read every pair of partitions, as they are, from where the blocks are written.
    """
    left, right = (blocks.select(*(F.col(c).alias(f"{c}{i}") for c in blocks.columns)) for i in (1, 2))
    near = F.expr("dim1 = dim2 AND abs(x1 - x2) <= 1 AND abs(y1 - y2) <= 1 AND no1 <= no2")
    pairs = left.join(right.hint("shuffle_replicate_nl"), near)
    return pairs.select((F.col("no1") == F.col("no2")).alias("alone"), *(f"{c}{i}" for i in (1, 2) for c in ("ks", "ns", "data")))


def _candidates(a: np.ndarray, b: np.ndarray, alone: bool, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of unit vectors a and b whose product may reach the cosine (alone: each pair once); single precision errs by less than what is allowed for."""
    left, right = a.astype(np.float32), b.astype(np.float32).T.copy()
    low = np.float32(cosine - 1e-5 - 1.5e-7 * (a.shape[1] + 4))
    for s in range(0, len(left), _CHUNK):
        product = left[s : s + _CHUNK] @ right
        i, j = np.divmod(np.flatnonzero(product >= low), len(b))
        i += s
        if alone:
            i, j = i[i < j], j[i < j]
        for t in range(0, len(i), 1 << 15):
            yield i[t : t + (1 << 15)], j[t : t + (1 << 15)]


def _links(pairs: DataFrame, size: int, kind: str, cosine: float) -> DataFrame:
    """Partial results of the block pairs: ``a``, ``b``, ``n``: links that connect what is linked (n null), or that class a has n linked vectors (b null)."""

    def read(row: dict, i: int) -> tuple[np.ndarray, ...]:
        k, n = (np.frombuffer(row[f"{c}{i}"], np.int64) for c in ("ks", "ns"))
        data = np.frombuffer(row[f"data{i}"], kind).reshape(len(k), -1)
        vectors = np.zeros((len(k), size))
        vectors[:, : data.shape[1]] = data
        return k, n, vectors, np.sqrt((vectors * vectors).sum(axis=1)), _unit(vectors)

    def compared(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
        one = read(row, 1)
        k, n, vectors, norms, units = one
        other, others, far, far_norms, far_units = one if row["alone"] else read(row, 2)
        degree, far_degree = np.zeros(len(k), np.int64), np.zeros(len(other), np.int64)
        for i, j in _candidates(units, far_units, row["alone"], cosine):
            linked = (vectors[i] * far[j]).sum(axis=1) / (norms[i] * far_norms[j]) >= cosine
            i, j = i[linked], j[linked]
            if len(i):
                np.add.at(degree, i, others[j])
                np.add.at(far_degree, j, n[i])
                yield *forest(k[i], other[j]), None
        for x, d in ((k, degree), (other, far_degree)):
            some = np.flatnonzero(d)
            if len(some):
                yield x[some], None, d[some]

    def batches_of(found: list) -> Iterator[pa.RecordBatch]:
        """What was found, with links and numbers that belong together made one."""
        edges, numbers = [f for f in found if f[2] is None], [f for f in found if f[1] is None]
        if edges:
            yield batch(*forest(*(np.concatenate([f[i] for f in edges]) for i in (0, 1))), None)
        if numbers:
            k, at = np.unique(np.concatenate([f[0] for f in numbers]), return_inverse=True)
            sums = np.zeros(len(k), np.int64)
            np.add.at(sums, at, np.concatenate([f[2] for f in numbers]))
            yield batch(k, None, sums)

    def batch(a, b, n) -> pa.RecordBatch:
        empty = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a), empty if b is None else pa.array(b), empty if n is None else pa.array(n)], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for b in batches:
            for at in range(b.num_rows):
                row = {c: b.column(c)[at] for c in b.schema.names}
                row = {c: v.as_py() if c == "alone" else v.as_buffer() for c, v in row.items()}
                for f in compared(row):
                    found.append(f)
                    held += len(f[0])
                    if held >= 1 << 21:
                        yield from batches_of(found)
                        found, held = [], 0
        yield from batches_of(found)

    return pairs.mapInArrow(run, "a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` and ``kept`` (it is its component's smallest id).

    Two rows link if the cosine of their vectors, in double precision, is at
    least ``cosine`` (above 0). Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, nor do vectors of different
    lengths. Equal vectors meet before the join and count by their number, so
    ids may repeat or be null (then ``component_id`` is the smallest id that is
    not null, and a row alone keeps its own); an empty table gives an empty
    result. Only links that keep components connected leave a task, with the
    number of links of each of its vectors.
    """
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    values = F.col(vector_col).cast("array<float>" if single else "array<double>")
    finite = F.forall(values, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    usable = F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable, values).alias("vector"))
    classes = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    classes = checkpointed(classes.withColumn("k", F.monotonically_increasing_id()))
    size, n_classes = classes.agg(F.max(F.size("vector")), F.count(F.lit(1))).first()
    if size is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    cores = classes.sparkSession.sparkContext.defaultParallelism
    parts = classes.coalesce(max(math.isqrt(32 * cores), 8 * size * n_classes // PARTITION))  # each is read with each
    blocks = checkpointed(_blocks(parts, _moments(classes, size), cosine).withColumn("no", F.monotonically_increasing_id()))
    found = checkpointed(_links(_block_pairs(blocks), size, "f4" if single else "f8", cosine))
    roots = components(found.where("b IS NOT NULL").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    degrees = found.where("n IS NOT NULL").groupBy(F.col("a").alias("k")).agg(F.sum("n").alias("links"))
    rooted = classes.join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").join(degrees, "k", "left")
    named = named.select("vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    return rows.join(named, "vector", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )
