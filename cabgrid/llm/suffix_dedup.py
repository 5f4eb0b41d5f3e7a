"""Exact removal of long repeats by column-wise construction over aligned text windows.

The column-wise construction of a collection's Burrows-Wheeler transform adds
one symbol of every document in each round: it sorts the documents, stably, by
the new symbol ahead of the order of the rounds before, and updates the common
prefixes of neighbours. Run over whole texts this takes as many rounds as the
longest text has bytes. Here the collection is cut into windows around anchors
that equal strings share, so the rounds of all windows are few and fixed, and
windows that cannot match never meet:

1. Anchors. In every string of ``LENGTH`` bytes the ``GRAM`` bytes with the
   smallest hash are its anchor. Equal strings have equal anchors at equal
   places, so a string recurs only if its anchor's hash does.
2. Windows. A window holds all strings of one anchor. Windows of equal hash
   and equal content form a class; in classes of several every string recurs.
3. Columns. The other classes of a hash are columns of symbols aligned at the
   anchor. From right to left, each round permutes the symbols of one column
   into suffix order (the transform's column) and updates where the common
   prefix with the next suffix ends. Prefixes of ``LENGTH`` bytes are matches.

A hash with many classes is split over tasks; strings that find no match in
their part are then counted over all parts by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import join_documents, keyed, slices, whole_groups, written

#: Bytes of a string that counts as a repeat, and of an anchor.
LENGTH, GRAM = 200, 48
#: Strings of one anchor; a window holds the bytes of them all.
STRINGS = LENGTH - GRAM + 1
WIDTH = LENGTH + STRINGS - 1
#: Strings of a window that are compared together where its hash is split.
STEP = 17
#: Classes of one hash that a task takes; more are split.
PART = 1024

_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 17
_U = np.uint64


class _Rolling:
    """Hash of every GRAM bytes: sums of random values times powers of an odd base, modulo 2**64."""

    def __init__(self, n: int = 2 * _BLOCK):
        self.table = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.powers = np.cumprod(np.full(n, _BASE, np.uint64))
        self.inverse = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.powers):
            self.__init__(2 * n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[:n], out=sums[1:])
        h = sums[GRAM:] - sums[:-GRAM]
        h *= self.inverse[: len(h)]
        h ^= h >> _U(29)
        h *= _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(32)
        return h


def _sliding(x: np.ndarray, width: int, best: np.ufunc, filler: int) -> np.ndarray:
    """The best of every ``width`` values in a row, from running bests of blocks in both directions."""
    n = len(x) - width + 1
    blocks = np.concatenate([x, np.full(-len(x) % width, filler, x.dtype)]).reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(parts: list[bytes], rolling: _Rolling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of all anchors of the texts; of equal smallest hashes in a string all are anchors."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.cumsum([len(p) for p in parts])
    h = rolling(data)
    high = (h >> _U(32)).astype(np.uint32) | np.uint32(1)  # zero marks strings that cross texts
    low = _sliding(high, STRINGS, np.minimum, 0xFFFFFFFF)
    for e in ends[:-1]:
        low[max(0, e - LENGTH + 1) : e] = 0
    edge = np.zeros(STRINGS - 1, np.uint32)
    most = _sliding(np.concatenate([edge, low, edge]), STRINGS, np.maximum, 0)
    at = np.flatnonzero(most == high)
    row = np.searchsorted(ends, at, "right")
    return row, at - np.concatenate([[0], ends])[row], h[at].view(np.int64)


def _grouped(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about _BLOCK bytes together, with the row of the first."""
    held, size, first = [], 0, 0
    for i, x in enumerate(texts):
        held.append(x.as_py())
        size += len(held[-1])
        if size >= _BLOCK:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _bounds(pos: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the windows of anchors, within their texts."""
    return np.maximum(0, pos - STRINGS + 1), np.minimum(n, pos + LENGTH)


def find_anchors(docs: DataFrame) -> DataFrame:
    """``id``, ``th``, ``pos``, ``h`` of all anchors, and the ``digest`` of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = _Rolling()
        for b in slices(batches, "raw", 1 << 23):
            for first, parts in _grouped(b.column("raw")):
                row, pos, h = anchors(parts, rolling)
                start, end = _bounds(pos, np.array([len(p) for p in parts], np.int64)[row])
                places = zip(row.tolist(), start.tolist(), end.tolist(), (pos - start).tolist())
                digest = xxhash.xxh3_64_intdigest
                digests = np.fromiter((digest(parts[i][s:e], before) for i, s, e, before in places), np.uint64, len(row))
                rows = pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(rows), b.column("th").take(rows), pa.array(pos.astype(np.int32)), pa.array(h),
                     pa.array(digests.view(np.int64))],
                    ["id", "th", "pos", "h", "digest"],
                )

    schema = f"id {docs.schema['id'].dataType.simpleString()}, th bigint, pos int, h bigint, digest bigint"
    return docs.mapInArrow(run, schema)


def count_anchors(docs: DataFrame) -> DataFrame:
    """``h`` and ``n``: the hashes of all anchors and how often a slice of the texts has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = _Rolling()
        for b in slices(batches, "raw", 1 << 23):
            hashes = [anchors(parts, rolling)[2] for _, parts in _grouped(b.column("raw"))]
            h, n = np.unique(np.concatenate([np.empty(0, np.int64), *hashes]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], ["h", "n"])

    return docs.select("raw").mapInArrow(run, "h bigint, n bigint")


def _windows(texts: DataFrame) -> DataFrame:
    """The windows that stand for the classes to compare: those of ``found`` with a number of ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "raw", 1 << 22):
            found, raws = b.column("found"), b.column("raw")
            entries = found.flatten()
            stands = np.flatnonzero(entries.field("parts").is_valid().to_numpy(zero_copy_only=False))
            if not len(stands):
                continue
            entries = entries.take(pa.array(stands))
            row = np.repeat(np.arange(b.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))[stands]
            texts = {i: raws[i].as_py() for i in np.unique(row).tolist()}
            sizes = np.array([len(texts.get(i, b"")) for i in range(b.num_rows)], np.int64)
            pos = entries.field("pos").to_numpy().astype(np.int64)
            start, end = _bounds(pos, sizes[row])
            windows = [texts[i][s:e] for i, s, e in zip(row.tolist(), start.tolist(), end.tolist())]
            given = [entries.field(c) for c in ("h", "digest", "parts", "several")]
            before = pa.array((pos - start).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*given, before, pa.array(windows, pa.binary())], names)

    names = ["h", "digest", "parts", "several", "before", "window"]
    return texts.select("raw", "found").mapInArrow(
        run, "h bigint, digest bigint, parts int, several boolean, before int, window binary"
    )


def match_columns(symbols: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which strings of aligned windows recur: flags by (window, string).

    ``symbols`` holds a row of WIDTH bytes per window, valid from ``first`` to
    before ``last``. Column by column from the right: ``order`` is the suffix
    order of the windows from this column on, ``end[k]`` the column where the
    k-th and the one before it stop being equal.
    """
    m = len(symbols)
    columns = np.ascontiguousarray(symbols.T)
    order = np.arange(m)
    end = np.full(m, WIDTH, np.int32)
    end[0] = 0
    found = np.zeros((m, STRINGS), bool)
    for j in range(WIDTH - 1, -1, -1):
        bwt = columns[j][order]
        by = np.argsort(bwt, kind="stable")
        sorted_symbols = bwt[by]
        new = np.empty(m, bool)
        new[0] = True
        np.not_equal(sorted_symbols[1:], sorted_symbols[:-1], out=new[1:])
        # neighbours of one symbol share what all suffixes between them share
        same = np.flatnonzero(~new)
        fresh = np.full(m, j, np.int32)
        if len(same):
            spans = np.empty(2 * len(same), np.int64)
            spans[0::2] = by[same - 1] + 1
            spans[1::2] = by[same] + 1
            fresh[same] = np.minimum.reduceat(np.append(end, 0), spans)[0::2]
        order, end = order[by], fresh
        if j < STRINGS:
            whole = (first[order] <= j) & (last[order] >= j + LENGTH)
            equal = np.zeros(m + 1, bool)
            equal[1:m] = (end[1:] >= j + LENGTH) & whole[1:] & whole[:-1]
            found[order, j] = equal[:-1] | equal[1:]
    return found


def _column_matches(windows: DataFrame) -> DataFrame:
    """Per class: ``h``, ``digest``, ``runs`` (its strings that recur in its part); if its hash is split, ``window`` and ``cores`` too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["h", "part"], 4 * PART):
            before = t.column("before").to_numpy()
            texts = t.column("window").to_pylist()
            symbols = np.full((len(texts), WIDTH), 0xFF, np.uint8)  # no byte of UTF-8
            first = STRINGS - 1 - before
            last = first + np.array([len(x) for x in texts])
            for row, a, x in zip(symbols, first.tolist(), texts):
                row[a : a + len(x)] = np.frombuffer(x, np.uint8)
            found = match_columns(symbols, first, last)
            inside = (first[:, None] <= np.arange(STRINGS)) & (last[:, None] >= np.arange(STRINGS) + LENGTH)
            found |= inside & t.column("several").to_numpy(zero_copy_only=False)[:, None]
            # runs of strings that recur, as (first, after the last)
            edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, begin = np.nonzero(edges == 1)
            runs = pa.StructArray.from_arrays(
                [pa.array(begin.astype(np.int32)), pa.array(np.nonzero(edges == -1)[1].astype(np.int32))], ["first", "after"]
            )
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)), runs)
            split = t.column("parts").to_numpy() > 1
            cores: list = [None] * len(texts)
            for i in np.flatnonzero(split):
                last_string = min(STRINGS, int(last[i]) - LENGTH + 1)
                cores[i] = [
                    {"step": k, "core": xxhash.xxh3_64_intdigest(symbols[i, c + STEP - 1 : c + LENGTH].tobytes(), k) - (1 << 63),
                     "open": bool((inside[i, c : c + STEP] & ~found[i, c : c + STEP]).any())}
                    for k, c in enumerate(range(0, STRINGS, STEP))
                    if inside[i, c : c + STEP].any() and first[i] <= c + STEP - 1 and c < last_string
                ]
            core = pa.struct([("step", pa.int32()), ("core", pa.int64()), ("open", pa.bool_())])
            yield pa.RecordBatch.from_arrays(
                [t.column("h").combine_chunks(), t.column("digest").combine_chunks(),
                 runs, pa.array(before, pa.int32()),
                 pa.array([x if y else None for x, y in zip(texts, split)], pa.binary()), pa.array(cores, pa.list_(core))],
                ["h", "digest", "runs", "before", "window", "cores"],
            )

    return windows.mapInArrow(
        run,
        "h bigint, digest bigint, runs array<struct<first: int, after: int>>, before int, window binary, cores array<struct<step: int, core: bigint, open: boolean>>",
    )


def _members(docs: DataFrame) -> DataFrame:
    """``id``, ``th``, ``every`` and ``found`` of the texts with anchors whose hash recurs.

    ``every`` lists the places of anchors where all strings of the window
    recur. ``found`` lists (pos, h, digest, several, parts) of the others:
    ``parts`` is null unless this window stands for its class in the comparison.
    """
    anchors = find_anchors(docs)
    twice = count_anchors(docs).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    members = written(anchors.join(twice, "h").select(*anchors.columns), "anchors")
    classes = members.groupBy("h", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("id", "th", "pos")).alias("stands")
    )
    mixed = (
        classes.groupBy("h")
        .agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("fewest"))
        .where("classes > 1 AND fewest = 1")
        .select("h", F.ceil(F.col("classes") / PART).cast("int").alias("parts"))
    )
    open_classes = classes.join(mixed, "h").withColumnsRenamed({"h": "h2", "digest": "digest2"})
    entry = F.struct(
        "pos",
        F.col("h2").alias("h"),
        F.col("digest2").alias("digest"),
        (F.col("n") > 1).alias("several"),
        F.when(F.col("stands") == F.xxhash64("id", "th", "pos"), F.col("parts")).alias("parts"),
    )
    joined = members.join(open_classes, (members["h"] == F.col("h2")) & (members["digest"] == F.col("digest2")), "left")
    settled = F.col("h2").isNull()
    return joined.groupBy("id", "th").agg(
        F.collect_set(F.when(settled, F.col("pos"))).alias("every"), F.collect_set(F.when(~settled, entry)).alias("found")
    )


def _matches(texts: DataFrame) -> DataFrame:
    """``h``, ``digest`` and ``runs`` of strings that recur, of the classes compared that have any."""
    windows = _windows(texts).withColumn("part", F.pmod("digest", "parts")).repartition("h", "part")
    matches = written(_column_matches(windows.sortWithinPartitions("h", "part", "digest")), "matches")
    # Strings of split hashes, over all parts. The STEP strings from each step on have a core of bytes in common; only
    # windows whose core is another one's too, where one of them has a string not found yet, compare these strings.
    split = matches.where("window IS NOT NULL")
    cores = split.select("h", "digest", F.explode("cores").alias("c")).select("h", "digest", "c.step", "c.core", "c.open")
    again = cores.groupBy("h", "step", "core").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("any_open"))
    again = again.where("n > 1 AND any_open").select("h", "step", "core")
    asking = cores.join(again, ["h", "step", "core"]).select("h", "digest", "step")
    string = F.explode(F.expr(f"sequence(step * {STEP}, least(step * {STEP} + {STEP}, {STRINGS}) - 1)"))
    ask = split.select("h", "digest", "before", "window").join(asking, ["h", "digest"]).withColumn("string", string)
    ask = ask.withColumn("at", F.col("string") - (STRINGS - 1) + F.col("before"))
    ask = ask.where(f"at >= 0 AND at + {LENGTH} <= length(window)").select(
        "h", "digest", "string", F.expr(f"xxhash64(substring(window, at + 1, {LENGTH}))").alias("hash")
    )
    again = ask.groupBy("h", "string", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    more = ask.join(again, ["h", "string", "hash"])
    more = more.groupBy("h", "digest").agg(F.collect_set("string").alias("s"))
    beyond = more.selectExpr(
        "h",
        "digest",
        "zip_with(sort_array(filter(s, x -> NOT array_contains(s, x - 1))), sort_array(filter(s, x -> NOT array_contains(s, x + 1))),"
        " (a, z) -> struct(a AS first, z + 1 AS after)) AS beyond",
    )
    both = matches.select("h", "digest", "runs").join(beyond, ["h", "digest"], "left")
    runs = F.concat("runs", F.coalesce("beyond", F.array().cast("array<struct<first: int, after: int>>")))
    return both.select("h", "digest", runs.alias("runs")).where("size(runs) > 0")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``spans``, ``kept`` (bytes; null if all stay), ``sha256`` of what stays.

    Removes every byte covered by a string of ``LENGTH`` bytes that also
    starts anywhere else in the table, judged on the input; ``spans`` lists
    the maximal removed runs as (start, length). Texts are UTF-8 bytes, and a
    cut may fall inside a character. Null and empty texts have no bytes;
    rows that repeat an id and a text are copies of each other, so all of
    their strings recur; an empty table gives an empty result.

    Everything moves by equality joins and aggregates that combine map-side
    or that adaptive execution splits. The whole text is shuffled once; after
    that only texts with a recurring anchor are, and those are written to the
    shared folder.
    """
    docs = keyed(docs, id_col, text_col)
    members = _members(docs)
    texts = join_documents(docs, members)
    texts = written(texts, "repeats")
    opened = texts.select("id", "th", F.explode("found").alias("a"))
    marks = opened.select("id", "th", "a.pos", "a.h", "a.digest").join(_matches(texts), ["h", "digest"])
    # the first byte of a run of strings and their number, as one number
    mark = f"transform(runs, r -> CAST(pos - {STRINGS - 1} + r.first AS bigint) * 256 + r.after - r.first)"
    marks = marks.groupBy("id", "th").agg(F.array_distinct(F.flatten(F.collect_list(F.expr(mark)))).alias("marks"))
    mixed = F.size("found") > 0
    marked = join_documents(texts.where(mixed).select("id", "th", "raw", "every"), marks, "left")
    settled = texts.where(~mixed).select("id", "th", "raw", "every", F.lit(None).cast("array<bigint>").alias("marks"))
    marked = marked.unionByName(settled).withColumn("marks", F.coalesce("marks", F.array().cast("array<bigint>")))
    id_type = docs.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    names = ["id", "th", "n_removed", "spans", "kept", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "raw", 1 << 22):
            rows = []
            for x, every, marks in zip(b.column("raw"), b.column("every"), b.column("marks")):
                raw = x.as_py()
                edge = np.zeros(len(raw) + 1, np.int32)
                pos = every.values.to_numpy()
                start, end = np.maximum(0, pos - STRINGS + 1), np.minimum(len(raw), pos + LENGTH)
                long = end - start >= LENGTH
                np.add.at(edge, start[long], 1)
                np.add.at(edge, end[long], -1)
                first, n = np.divmod(marks.values.to_numpy(), 256)
                np.add.at(edge, first, 1)
                np.add.at(edge, first + n - 1 + LENGTH, -1)
                gone = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
                turns = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
                spans = list(zip(turns[::2], turns[1::2]))
                cuts = [0, *turns, len(raw)]
                kept = b"".join(raw[s:e] for s, e in zip(cuts[::2], cuts[1::2]))
                rows.append(
                    (len(raw) - len(kept), [{"start": s, "length": e - s} for s, e in spans], kept, hashlib.sha256(kept).hexdigest())
                )
            made = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), span, pa.binary(), pa.string()])]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), *made], names)

    schema = f"id {id_type}, th bigint, n_removed bigint, spans array<struct<start: bigint, length: bigint>>, kept binary, kept_sha256 string"
    cut = marked.mapInArrow(run, schema).where("n_removed > 0").dropDuplicates(["id", "th"])
    whole = docs.select("id", "th", F.octet_length("raw").cast("long").alias("n_bytes"), F.sha2("raw", 256).alias("sha256"))
    return join_documents(whole, cut, "left").select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<start: bigint, length: bigint>>")).alias("spans"),
        "kept",
        F.coalesce("kept_sha256", "sha256").alias("sha256"),
    )
