"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments (two at least), so that of two
fingerprints within ``max_bits`` one segment differs by one bit at most. Every
segment is indexed once for each of its bits, with that bit as a wildcard; an
equality join on these variants finds all candidates and a bit count verifies
them in the join condition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import checkpointed, components, keyed, slices

#: Fixed value: the seed of Spark's xxhash64.
SEED = 42
_BLOCK = 1 << 17


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduce(bits, axis=0, dtype=np.int64)


def fingerprint(raw: bytes, shingle: int) -> int:
    """Unsigned SimHash of a text: bit i is 1 if set in over half of the shingles' hashes."""
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    ends = ends[-n:]
    digest, sums = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        cut = zip(starts[i : min(i + _BLOCK, n)].tolist(), ends[i : i + _BLOCK].tolist())
        sums += _bit_sums(np.array([digest(line[s:e], SEED) for s, e in cut], np.uint64))
    return int(np.packbits(2 * sums > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``th``, ``fp`` (the fingerprint as a signed long) per row; a null or empty text gives zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "raw", 1 << 24):
            fps = np.fromiter((fingerprint(x.as_py(), shingle) for x in b.column("raw")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(fps.view(np.int64))], ["id", "th", "fp"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, th bigint, fp bigint"
    return keyed(docs, id_col, text_col).mapInArrow(run, schema)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    n = max(2, max_bits // 2 + 1)
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """All pairs ``src`` < ``dst`` of the distinct fingerprints in ``fp`` with at most ``max_bits`` different bits.

    Each pair comes out once: from the first segment that differs by at most
    one bit, at the differing bit, or at the segment's first bit if it is
    equal. As fingerprints are distinct here, a fingerprint has links only to
    others in its Hamming ball, however many copies the documents have. The
    join is told to sort and merge: Spark sizes the index as if a fingerprint
    had one variant, and would broadcast it.
    """
    segments = _segments(max_bits)
    seg = lambda col, a, w: f"(shiftrightunsigned({col}, {a}) & {(1 << w) - 1}L)"
    variants = ", ".join(
        f"{bit}L << 56 | ({seg('fp', a, w)} & {((1 << w) - 1) ^ (1 << (bit - a))}L)"
        for a, w in segments
        for bit in range(a, a + w)
    )
    index = fps.select("fp").distinct().selectExpr("fp", f"posexplode(array({variants})) AS (bit, key)")
    first = "CASE"
    for a, w in segments:
        diff = seg("(l.fp ^ r.fp)", a, w)
        first += f" WHEN bit_count({diff}) <= 1 THEN l.bit = CASE WHEN {diff} = 0 THEN {a} ELSE {a} + bit_count({diff} - 1) END"
    on = F.expr(
        f"l.bit = r.bit AND l.key = r.key AND l.fp < r.fp AND bit_count(l.fp ^ r.fp) <= {max_bits} AND {first} ELSE false END"
    )
    return index.alias("l").join(index.alias("r").hint("merge"), on).select(F.col("l.fp").alias("src"), F.col("r.fp").alias("dst"))


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fingerprint`` (16 hex digits), ``component_id`` and ``kept`` for each row of ``docs``.

    Documents link if their fingerprints differ in at most ``max_bits`` bits;
    the component's id is its smallest ``doc_id``, and the document that has
    it is kept (of several, the one with the smallest hash of its text; rows
    that repeat it all say so). Null and empty texts have fingerprint zero and
    link like any other; an id that is null is larger than all others. An
    empty table gives an empty result. Copies meet in their fingerprint before
    any pairing, and the joins back to documents are equality joins that
    adaptive execution splits when a key is hot.
    """
    fps = checkpointed(fingerprints(docs, shingle, id_col, text_col))
    classes = fps.groupBy("fp").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "th")).alias("low"))
    roots = components(links(classes, max_bits)).withColumnsRenamed({"node": "fp"})
    rooted = classes.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("first"))
    named = rooted.join(lowest, "root").select("fp", "first")
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.col("th").alias("text_hash"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th"))).alias("kept"),
    )
