"""Helpers shared by the operators: document keys, Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabgrid.session import checkpoint_root, scratch_path

#: Fixed value: a word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_text(text_col: str = "text") -> Column:
    """A text's UTF-8 bytes (null: empty)."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")


def text_hash(text_col: str = "text") -> Column:
    """The 64-bit hash of a text that makes, with its id, the key of a document."""
    return F.xxhash64(raw_text(text_col))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``th``, ``raw``: the id, a 64-bit hash of the text and its UTF-8 bytes (null: empty).

    (id, th) is the key of a document inside the operators, so that rows that
    repeat an id with another text, or have no id, stay apart.
    """
    return docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), raw_text(text_col).alias("raw"))


def join_documents(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right`` for the same document (``id``, ``th``)."""
    right = right.withColumnsRenamed({"id": "right_id", "th": "right_th"})
    return left.join(right, F.expr("id <=> right_id AND th = right_th"), how).drop("right_id", "right_th")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder: its lineage ends here."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as compressed Parquet: its lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of whole rows with about ``max_bytes`` of a binary column."""
    for batch in batches:
        offsets = np.cumsum(
            [0, *(len(x) if x is not None else 0 for x in (v.as_buffer() for v in batch.column(column)))]
        )
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows (the last may be smaller) that never cut a run of equal keys."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        whole = pa.Table.from_batches(held)
        changed = np.zeros(n, bool)
        for k in keys:
            v = whole.column(k).to_numpy()
            changed[1:] |= v[1:] != v[:-1]
        cut = np.flatnonzero(changed)
        if not len(cut):
            continue
        yield whole.slice(0, cut[-1])
        held = whole.slice(cut[-1]).combine_chunks().to_batches()
        n -= int(cut[-1])
    if n:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (``src``, ``dst``, non-null longs).

    Returns ``node``, ``root`` (the smallest node of its component) for every
    node with an edge to another one. Alternating large-star and small-star
    steps; each round is written to the checkpoint folder and only its row
    count and hash sum reach the driver. Joins on busy nodes are left to
    adaptive skew splitting, and every distinct combines map-side.
    """
    now = checkpointed(
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .where("src <> dst")
        .distinct()
    )
    seen = None
    while True:  # until a round changes nothing
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
                now.select("dst", "dst").distinct()
            )
        seen = tuple(mark)
        both = now.union(now.select("dst", "src"))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = (
            both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()
        )
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(low, "src")
        now = checkpointed(
            small.select(F.col("dst").alias("src"), F.col("m").alias("dst"))
            .union(small.select("src", F.col("m").alias("dst")))
            .where("src <> dst")
            .distinct()
        )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node reachable) that connect the same nodes as the links (a, b)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]
