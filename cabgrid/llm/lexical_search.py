"""Ranked lexical search of a set of items over all documents, evaluating what items share once.

Terms that occur in the same items form one class, so a document's score for
the class is a subexpression of all of them. Ordered from the most shared
class to the least, the classes of items with common beginnings lie on one
path of a tree: each of its nodes is a partial accumulator of scores per
document, worked out once for all items below and then combined with what
only some of them have. The items are split into blocks of a checked size.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.llm.common import checkpointed, raw_text, slices, written

#: Fixed value: a term is a run of ASCII letters and digits and of all code points beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Maps a byte to its lower case in a term and to a blank outside.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: (item, term) rows in a block of items, the bound of what the driver and a task hold of the items.
BLOCK = 200_000
#: Documents and postings whose accumulators a task holds at a time.
DOCUMENTS = 4096
POSTINGS = 1 << 21
#: Parts of an item's candidates that are ranked before the item's whole ranking.
PARTS = 64


class SharedPlan:
    """The query-sharing DAG of a block of items.

    ``class_of`` gives each term's class: the terms with the same set of
    items. ``steps`` evaluates the tree in depth-first order as (depth,
    classes, items): copy the accumulator of ``depth``, add the classes to the
    copy, and rank the items that end there. Chains without a branch are one
    step, so only accumulators that several items share are kept.
    """

    def __init__(self, items: list[list[str]]):
        holders: dict[str, list[int]] = defaultdict(list)
        for i, terms in enumerate(items):
            for t in terms:
                holders[t].append(i)
        self.terms = sorted(holders)
        classes: dict[tuple, int] = {}
        found = [classes.setdefault(tuple(holders[t]), len(classes)) for t in self.terms]
        self.class_of = np.array(found, np.int64)
        self.n_classes = len(classes)
        # the most shared class first; equal ones by their first term
        ranked = sorted(classes, key=lambda held: (-len(held), classes[held]))
        paths: list[list[int]] = [[] for _ in items]
        for held in ranked:
            for i in held:
                paths[i].append(classes[held])
        self.steps: list[tuple[int, list[int], list[int]]] = []
        self._grow(paths)

    def _grow(self, paths: list[list[int]]) -> None:
        def branches(members: list[int], at: int, depth: int) -> list[tuple]:
            by_class: dict[int, list[int]] = defaultdict(list)
            for i in members:
                by_class[paths[i][at]].append(i)
            return [(held, at, depth) for held in by_class.values()]

        stack = branches([i for i, p in enumerate(paths) if p], 0, 0)
        while stack:
            held, at, depth = stack.pop()
            path, end = paths[held[0]], at + 1
            while end < len(path) and all(len(paths[i]) > end and paths[i][end] == path[end] for i in held):
                end += 1
            self.steps.append((depth, path[at:end], [i for i in held if len(paths[i]) == end]))
            stack += branches([i for i in held if len(paths[i]) > end], end, depth + 1)


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``rid``, ``item``, ``terms`` of the items that have terms, and into how many blocks by ``rid`` they go."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _LOWER)
    terms = F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))
    rows = items.select(F.col(id_col).alias("item"), terms.alias("terms")).where(F.size("terms") > 0)
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()), "items")
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    blocks = max(1, -(-(total or 0) // BLOCK))
    while blocks < n:
        sums = rows.groupBy((F.col("rid") % blocks).alias("b")).agg(F.sum(F.size("terms")).alias("s"))
        if sums.agg(F.max("s")).first()[0] <= 2 * BLOCK:
            break
        blocks = min(2 * blocks, n)
    return rows, blocks if n else 0


def _postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Per document with a term: ``id``, ``n`` (all its terms) and, of the given ``terms``, their numbers and counts."""
    known = docs.sparkSession.sparkContext.broadcast({t.encode(): i for i, t in enumerate(terms)})
    width = max(1, len(terms))

    def counted(words: list[bytes], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.fromiter(map(known.value.get, words, repeat(-1)), np.int64, len(words))
        found = ids >= 0
        return np.unique(owner[found] * width + ids[found], return_counts=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "raw", 1 << 22):
            n = np.zeros(part.num_rows, np.int64)
            held, words = [], []
            for i, value in enumerate(part.column("raw")):
                text = value.as_buffer().to_pybytes().translate(_BYTES)
                at = 0
                while at < len(text):  # a long text in pieces that end at blanks
                    end = text.find(b" ", at + (1 << 22))
                    found = text[at : end if end >= 0 else None].split()
                    at = end if end >= 0 else len(text)
                    n[i] += len(found)
                    words.append((i, found))
                    if end >= 0:
                        held.append(_flush(words, counted))
                        words = []
            held.append(_flush(words, counted))
            keys, counts = (np.concatenate(x) for x in zip(*held))
            keys, at = np.unique(keys, return_inverse=True)
            tf = np.bincount(at, counts, len(keys)).astype(np.int32)
            row, term = np.divmod(keys, width)
            some = np.flatnonzero(n)
            ends = np.searchsorted(row, np.append(some, part.num_rows)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term.astype(np.int32), tf)]
            columns = [part.column("id").take(pa.array(some)), pa.array(n[some]), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    kind = docs.schema["id"].dataType.simpleString()
    return written(docs.mapInArrow(run, f"id {kind}, n bigint, terms array<int>, tfs array<int>"), "postings")


def _flush(words: list[tuple[int, list[bytes]]], counted) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat([i for i, _ in words], [len(w) for _, w in words]).astype(np.int64)
    return counted([w for _, found in words for w in found], owner)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``DOCUMENTS`` rows and about ``POSTINGS`` postings."""
    for batch in batches:
        ends = np.cumsum(np.append(0, batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + POSTINGS, "right")) - 1
            to = min(max(to, at + 1), at + DOCUMENTS)
            yield batch.slice(at, to - at)
            at = to


def _accumulators(block: pa.RecordBatch, plan: SharedPlan, weights: np.ndarray, n_docs: int, n_terms: int):
    """Yields (item, score of each document of the block for it), each shared accumulator worked out once."""
    size = block.num_rows
    m = 10 + 90 * block.column("n").to_numpy() * n_docs // n_terms
    term, tf = (block.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
    row = np.repeat(np.arange(size), block.column("terms").value_lengths().to_numpy(zero_copy_only=False))
    score = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
    key = plan.class_of[term] * size + row
    order = np.argsort(key, kind="stable")
    key, first = np.unique(key[order], return_index=True)
    score = np.add.reduceat(score[order], first) if len(first) else score
    of_class, row = np.divmod(key, size)
    ends = np.searchsorted(of_class, np.arange(plan.n_classes + 1))
    levels = [np.zeros(size, np.int64)]
    for depth, classes, items in plan.steps:
        own = levels[depth].copy()
        for c in classes:
            s, e = ends[c], ends[c + 1]
            if s < e:
                own[row[s:e]] += score[s:e]
        levels[depth + 1 :] = [own]
        for i in items:
            yield i, own


def _ranked(postings: DataFrame, plan: SharedPlan, rids: list[int], weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``rid``, ``id``, ``score``: each task's ``k`` best documents for each item."""
    shared = postings.sparkSession.sparkContext.broadcast((plan, weights))
    id_type = postings.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = shared.value
        best: list[list[tuple]] = [[] for _ in rids]
        kind = None
        for block in _blocks(batches):
            ids = block.column("id")
            kind = ids.type
            place = np.empty(block.num_rows, np.int64)  # in the order of the ids, null last
            place[pc.sort_indices(ids).to_numpy()] = np.arange(block.num_rows)
            for i, scores in _accumulators(block, plan, weights, n_docs, n_terms):
                held = best[i]
                at = np.flatnonzero(scores >= (-held[-1][0] if len(held) == k else 1))
                if not len(at):
                    continue
                if len(at) > k:
                    at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
                    at = at[np.lexsort((place[at], -scores[at]))[:k]]
                found = [(-int(scores[r]), x is None, x) for r, x in zip(at, ids.take(pa.array(at)).to_pylist())]
                best[i] = sorted(held + found)[:k]
        rows = [(rid, x, -s) for rid, held in zip(rids, best) for s, _, x in held]
        if rows:
            rid, x, s = zip(*rows)
            part = [TaskContext.get().partitionId() % PARTS] * len(rows)
            columns = [pa.array(rid), pa.array(x, kind), pa.array(s), pa.array(part)]
            yield pa.RecordBatch.from_arrays(columns, ["rid", "id", "score", "part"])

    found = postings.mapInArrow(run, f"rid bigint, id {id_type.simpleString()}, score bigint, part bigint")
    return _top(found, k, "rid", "part").drop("rank")


def _top(found: DataFrame, k: int, *keys: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Terms are the runs of ASCII letters and digits and code points beyond
    ASCII, with A-Z in lower case; a null text has none. With N documents that
    hold a term, L terms in all and n in one, a document scores, over the
    item's distinct terms, w * ((10**9 * tf) div (1000 * tf + 8 * m)), where
    w = floor(1000 * ln((2N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L.
    Listed are scores above 0, equal ones by ascending id (null last).

    Rows that repeat an id, or have none, are documents and items of their
    own; items without terms and empty tables give no rows; a text may have
    any length. The items go in blocks of at most ``2 * BLOCK`` (item, term)
    rows (one item alone may have more), each evaluated over all documents;
    the driver holds one block at a time. Documents are scored where they lie,
    and only each task's best ``k`` per item are shuffled.
    """
    rows, blocks = _item_blocks(items, item_col, item_text_col)
    texts = docs.select(F.col(id_col).alias("id"), raw_text(text_col).alias("raw"))
    id_type = texts.schema["id"].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"rid bigint, id {id_type}, score bigint")
    for b in range(blocks):
        held = rows.where(F.col("rid") % blocks == b).orderBy("rid").collect()  # a checked bound: see _item_blocks
        if not held:
            continue
        plan = SharedPlan([r["terms"] for r in held])
        postings = _postings(texts, plan.terms)
        n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        weights = np.zeros(len(plan.terms), np.int64)
        for term, df in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        ranked = _ranked(postings, plan, [r["rid"] for r in held], weights, n_docs, n_terms or 1, k)
        found = found.unionByName(checkpointed(ranked.drop("part")))
    return (
        _top(found, k, "rid")
        .join(rows.select("rid", "item"), "rid")
        .select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
    )
