"""Quality rules: word and repetition statistics, and lines that recur across the documents of a host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from cabgrid.llm.common import checkpointed, raw_text, slices, text_hash, unused

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in _STATS]
    + [("digest", pa.int64()), ("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())])))]
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five words that occur twice or more in the text.

    Windows compare by a 64-bit hash of their words.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    ids ^= ids >> np.uint64(31)
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h *= _MULTIPLIER
        h ^= ids[k : k + n] + (h >> np.uint64(29))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_hash(words: list[bytes]) -> int:
    """A normalised line's hash, from its words in ASCII lower case."""
    return _signed(xxhash.xxh3_64_intdigest(b" ".join(words)))


def describe(raw: bytes) -> tuple:
    """The statistics of one text, its digest, and (hash, words) of each distinct normalised line."""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    per_line: dict[int, int] = {}
    for x in lines:
        parts = x.lower().split()
        key = line_hash(parts)
        per_line[key] = per_line.get(key, 0) + len(parts)
    return (
        len(words),
        len(raw.translate(None, SPACE + CONTINUATION)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        _signed(xxhash.xxh3_64_intdigest(raw)),
        [{"line": k, "words": v} for k, v in per_line.items()],
    )


def described(docs: DataFrame, id_col: str, text_col: str, host: Column) -> DataFrame:
    """``id``, ``th``, ``host``, the statistics, ``digest`` and ``lines`` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "raw", 1 << 24):
            cols = list(zip(*(describe(x.as_py()) for x in b.column("raw"))))
            made = [pa.array(v, f.type) for v, f in zip(cols, _SCHEMA)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "th", "host")), *made], ["id", "th", "host", *_SCHEMA.names])

    id_type = docs.schema[id_col].dataType.simpleString()
    stats = ", ".join(f"{c} bigint" for c in _STATS)
    cols = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), host.alias("host"), raw_text(text_col).alias("raw"))
    return cols.mapInArrow(
        run, f"id {id_type}, th bigint, host string, {stats}, digest bigint, lines array<struct<line: bigint, words: bigint>>"
    )


def _host(host_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit(""))


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = 20,
    min_left: float = 0.3,
) -> DataFrame:
    """One row per row of ``docs``: id, ``text_hash``, ``host``, statistics, ``n_common_words``, ``common_lines``, ``base_failed``, ``kept``.

    A normalised line (ASCII lower case, single spaces) is common on a host if
    over ``min_documents`` distinct documents of the host have it, however many
    documents the host has; exact copies count as one document, so that
    copying does not make content look like page furniture. A document is
    rejected if fewer than ten words, or less than ``min_left`` of its words,
    are left without its common lines; ``common_lines`` has their hashes (null:
    none), by which ``without_common_lines`` removes them. Base rules reject texts under ten
    words and those with over 20 % of their words in repeated 5-word windows.

    Null and empty texts have no words and fail; documents without a host form
    a host of their own; rows that repeat an id each get a row. Lines count in
    two steps that combine map-side: per host, text and line, then per host
    and line; no step gathers the documents of a line.
    """
    rows = checkpointed(described(docs, id_col, text_col, _host(host_col)))
    texts = rows.select("host", "digest", F.explode("lines").alias("l")).select("host", "digest", "l.line", "l.words")
    texts = texts.groupBy("host", "digest", "line").agg(F.max("words").alias("words"))
    common = (
        texts.groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") > min_documents)
        .select("host", "line")
    )
    removed = (
        texts.join(common, ["host", "line"])
        .groupBy("host", "digest")
        .agg(F.sum("words").alias("n_common_words"), F.collect_list("line").alias("common_lines"))
    )
    left = F.col("n_words") - F.col("n_common_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        rows.join(removed, ["host", "digest"], "left")
        .withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0).cast("long")))
        .select(
            F.col("id").alias(id_col),
            F.col("th").alias("text_hash"),
            "host",
            *_STATS,
            "n_common_words",
            "common_lines",
            failed.alias("base_failed"),
            (~failed & (left >= MIN_WORDS) & (left >= min_left * F.col("n_words"))).alias("kept"),
        )
    )


def _cut(raw: pa.Array, lines: pa.Array) -> pa.Array:
    """Texts without the lines of these hashes; null where there are none."""
    out = []
    for x, gone in zip(raw, lines):
        gone = set(gone.as_py() or ())
        left = (y for y in x.as_py().split(b"\n") if line_hash(y.lower().split()) not in gone) if gone else ()
        out.append(b"\n".join(left) if gone else None)
    return pa.array(out, pa.binary())


def without_common_lines(
    docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Rows of ``docs`` whose document is in ``found`` (rows of ``quality``), with ``cut``: the text less its common lines.

    ``cut`` is null if the document has no common line. A line goes with one
    line end; all else, blank lines too, stays as it is.
    """
    names = unused(docs, "quality_id", "quality_hash", "quality_host", "quality_lines", "own_hash", "own_host")
    of_id, of_hash, of_host, lines, own_hash, own_host = names
    found = found.select(
        F.col(id_col).alias(of_id), F.col("text_hash").alias(of_hash), F.col("host").alias(of_host), F.col("common_lines").alias(lines)
    ).dropDuplicates(names[:3])
    rows = docs.withColumns({own_hash: text_hash(text_col), own_host: _host(host_col)})
    same = F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(own_hash) == F.col(of_hash)) & (F.col(own_host) == F.col(of_host))
    cut = F.arrow_udf(_cut, BinaryType())(raw_text(text_col), lines)
    return rows.join(found, same).select(*docs.columns, cut.cast("string").alias("cut"))
