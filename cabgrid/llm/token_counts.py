"""Token counts: a map-side two-tier lookup of pre-token lengths, with no shuffle of pre-tokens.

A byte-level BPE file cuts a text into pre-tokens and merges the bytes of each
by itself, so a text's token count is the sum over its pre-tokens. The first
tier is a compact hash table of frequent pre-tokens and their lengths in
tokens, broadcast to all tasks; what it misses goes to a worker's cache, and
what that misses to the tokenizer.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import checkpointed, raw_text, slices

#: Pre-tokens in the first tier, and the bytes of the longest one there.
FREQUENT = 1 << 15
LONGEST = 15
#: Pre-tokens that a worker remembers before it starts anew.
REMEMBERED = 500_000
#: Bytes of text cut at a time; longer texts are cut at blanks between signs.
PIECE = 1 << 22
#: Summaries merged by one task.
FAN_IN = 32

_OTHER, _LETTER, _NUMBER, _SPACE, _UNSURE = range(5)
#: The white space of Unicode whose class no version or library disputes.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
DISPUTED = [*range(0x1C, 0x20), 0x85, 0x180E]
#: The endings that the pre-tokenizer cuts off behind an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
#: A blank where a pre-token starts whatever lies further left or right.
_CUT = re.compile(rb"[!-~\xb0-\xbf] (?=[!-~\xc3-\xdf\xe4-\xf4])")


def code_point_classes() -> np.ndarray:
    """Letter, number, white space or other for each code point; ``_UNSURE`` where Unicode's versions disagree."""
    out = np.full(0x110000, _OTHER, np.uint8)
    kinds = {"L": _LETTER, "N": _NUMBER}
    for c in range(0x40000):  # beyond lie unassigned and private code points only
        now = unicodedata.category(chr(c))
        kind = kinds.get(now[0], _OTHER)
        old = kinds.get(unicodedata.ucd_3_2_0.category(chr(c))[0], _OTHER)
        out[c] = kind if kind == old and now != "Cn" else _UNSURE
    out[WHITE_SPACE] = _SPACE
    out[DISPUTED] = _UNSURE
    return out


class PreTokens:
    """Cuts texts into the pre-tokens of byte-level BPE, many texts at once."""

    def __init__(self, classes: np.ndarray, added: list[bytes]):
        self.classes = classes
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None

    def pieces(self, raw: bytes) -> Iterator[bytes]:
        """A text in pieces of about ``PIECE`` bytes, cut where a pre-token starts."""
        at = 0
        while len(raw) - at > PIECE:
            found = _CUT.search(raw, at + PIECE)
            if not found:
                break
            yield raw[at : found.start() + 1]
            at = found.start() + 1
        if at < len(raw):
            yield raw[at:]

    def __call__(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of non-empty texts: the joined bytes, where pre-tokens start in them, each one's text, and which texts are left out.

        Left out, with no bytes, are texts with disputed code points or with
        the content of an added token: the tokenizer takes them whole.
        """
        try:
            text = b"".join(parts).decode()
        except UnicodeDecodeError:  # as the tokenizer gets it: replacement signs
            parts = [p.decode("utf-8", "replace").encode() for p in parts]
            text = b"".join(parts).decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        raw = np.frombuffer(b"".join(parts), np.uint8)
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        ends = np.cumsum([len(p) for p in parts])
        kind = self.classes[points]
        first = np.searchsorted(lead, np.concatenate([[0], ends[:-1]]))
        left_out = np.zeros(len(parts), bool)
        unsure = np.flatnonzero(kind == _UNSURE)
        left_out[np.searchsorted(first, unsure, "right") - 1] = True
        if self.added is not None:
            left_out |= np.fromiter((self.added.search(p) is not None for p in parts), bool, len(parts))
        if left_out.any():
            kept = [p for p, x in zip(parts, left_out) if not x]
            if not kept:
                return raw[:0], lead[:0], lead[:0], left_out
            raw, starts, owner, _ = PreTokens(self.classes, [])(kept)
            return raw, starts, np.flatnonzero(~left_out)[owner], left_out
        start = np.zeros(len(points), bool)
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        start[first] = False
        # the last of several blanks stands apart, and a plain one goes with what follows
        after = np.flatnonzero(start[1:] & (kind[:-1] == _SPACE)) + 1
        start[first] = True
        start[after - 1] = True
        start[after[points[after - 1] == 0x20]] = False
        self._endings(points, start, first)
        at = np.flatnonzero(start)
        return raw, lead[at], np.searchsorted(first, at, "right") - 1, left_out

    @staticmethod
    def _endings(points: np.ndarray, start: np.ndarray, first: np.ndarray) -> None:
        marks = np.flatnonzero((points == 0x27) & start)
        marks = marks[marks + 1 < len(points)]
        if not len(marks):
            return
        text_of = np.searchsorted(first, marks, "right")
        limit = np.append(first, len(points))[text_of]
        padded = np.append(points, np.zeros(2, np.uint32))
        for ending in ENDINGS:
            n = len(ending)
            same = marks + n < limit
            for i, c in enumerate(ending):
                same &= padded[np.minimum(marks + 1 + i, len(points))] == ord(c)
            hit = marks[same]
            start[hit + 1] = False
            inside = hit + 1 + n
            start[inside[inside < len(points)]] = True


def _words(raw: np.ndarray, starts: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(np.append(starts, len(raw)).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(raw)])


def _keys(raw: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and length of pre-tokens of up to ``LONGEST`` bytes as two integers: equal keys, equal pre-tokens."""
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    mask = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
    low = words[starts] & mask[np.minimum(n, 8)]
    high = words[starts + 8] & mask[np.clip(n - 8, 0, 8)]
    return low, high | n.astype(np.uint64) << np.uint64(56)


class Lengths:
    """A hash table with open addressing: pre-tokens of up to ``LONGEST`` bytes to their lengths in tokens."""

    def __init__(self, words: list[bytes], tokens: list[int]):
        self.bits = max(1, (2 * len(words)).bit_length())
        size = 1 << self.bits
        self.low, self.high = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.tokens = np.zeros(size, np.uint8)
        if not words:
            return
        n = np.array([len(w) for w in words])
        low, high = _keys(np.frombuffer(b"".join(words), np.uint8), np.cumsum(n) - n, n)
        for i, slot in enumerate(self._slots(low, high).tolist()):
            while self.high[slot]:
                slot = (slot + 1) % size
            self.low[slot], self.high[slot], self.tokens[slot] = low[i], high[i], tokens[i]

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ high * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, raw: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token, 0 where the table misses it."""
        out = np.zeros(len(starts), np.int64)
        rows = np.flatnonzero(n <= LONGEST)
        low, high = _keys(raw, starts[rows], n[rows])
        slots = self._slots(low, high)
        while len(rows):
            there = self.high[slots]
            hit = (there == high) & (self.low[slots] == low)
            out[rows[hit]] = self.tokens[slots[hit]]
            on = ~hit & (there != 0)
            rows, low, high, slots = rows[on], low[on], high[on], (slots[on] + 1) % len(self.high)
        return out


def _load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values() if t.content]


def _encode(tokenizer, words: list[bytes]) -> list[int]:
    """Lengths in tokens of single pre-tokens (invalid UTF-8 as the replacement sign)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # byte-level BPE shows these as they are
    letters = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    model = tokenizer.model
    return [len(model.tokenize(w.decode("latin-1").translate(letters))) for w in words]


def _cut(batches: Iterator[pa.RecordBatch], cutter: PreTokens) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[bytes]]]:
    """Slices of the batches, each with its non-empty texts in pieces and each piece's row."""
    for part in slices(batches, "raw", PIECE):
        pieces, owner = [], []
        for i, value in enumerate(part.column("raw")):
            cut = [*cutter.pieces(value.as_buffer().to_pybytes())]
            pieces += cut
            owner += [i] * len(cut)
        yield part, np.array(owner, np.int64), pieces


def _pruned(counts: Counter, size: int) -> Counter:
    """At most ``size`` entries, all lowered by the largest count left out: every entry stays a lower bound."""
    if len(counts) <= size:
        return counts
    top = counts.most_common(size + 1)
    floor = top[-1][1]
    return Counter({w: n - floor for w, n in top[:-1] if n > floor})


def frequent_words(texts: DataFrame, classes, added: list[bytes], size: int = FREQUENT) -> list[bytes]:
    """Up to ``size`` frequent pre-tokens of all texts (column ``raw``), by mergeable summaries.

    Each task counts all its pre-tokens of up to ``LONGEST`` bytes and keeps
    at most ``size`` of them (Misra-Gries: counts are lowered by what is cut,
    so any pre-token in over 1/size of the total stays). One row per task
    holds its summary; tasks merge ``FAN_IN`` summaries each until one is
    left. Pre-tokens are never shuffled.
    """
    kind = "part bigint, words array<binary>, counts array<bigint>"

    def row(counts: Counter, part: int) -> pa.RecordBatch:
        words, n = [*counts], [*counts.values()]
        arrays = [pa.array([part]), pa.array([words], pa.list_(pa.binary())), pa.array([n], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["part", "words", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, counts = PreTokens(classes.value, added), Counter()
        for _, _, pieces in _cut(batches, cutter):
            if not pieces:
                continue
            raw, starts, _, _ = cutter(pieces)
            n = np.diff(starts, append=len(raw))
            words = _words(raw, starts).filter(pa.array(n <= LONGEST))
            pairs = pc.value_counts(words)
            counts.update(dict(zip(pairs.field("values").to_pylist(), pairs.field("counts").to_pylist())))
            if len(counts) > 8 * size:
                counts = _pruned(counts, 4 * size)
        yield row(_pruned(counts, size), TaskContext.get().partitionId())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, Counter] = {}
        for batch in batches:
            for r in batch.to_pylist():
                held = groups.setdefault(r["part"] // FAN_IN, Counter())
                held.update(dict(zip(r["words"], r["counts"])))
                groups[r["part"] // FAN_IN] = _pruned(held, 2 * size)
        for part, counts in groups.items():
            yield row(_pruned(counts, size), part)

    found = checkpointed(texts.select("raw").mapInArrow(count, kind))
    while found.count() > 1:
        found = checkpointed(found.repartition(F.expr(f"part div {FAN_IN}")).mapInArrow(merge, kind))
    rows = found.collect()
    return [bytes(w) for w in rows[0]["words"]] if rows else []


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``n_tokens`` by the byte-level BPE file ``tokenizer``, and ``over_limit``.

    Counts are those of the ``tokenizers`` library without begin, end or
    added special tokens; the content of an added token inside a text counts
    as that token. A null text is empty and has no tokens. Repeated and null
    ids are documents of their own, in the order and partitions of the input;
    very long texts are cut at blanks where pre-tokens start. An empty table
    gives an empty result. The first tier holds ``FREQUENT`` pre-tokens of at
    most ``LONGEST`` bytes (about a megabyte) and a worker's cache
    ``REMEMBERED`` lengths; neither decides a result.
    """
    library, added = _load(tokenizer)
    rows = docs.select(F.col(id_col).alias("id"), raw_text(text_col).alias("raw"))
    context = docs.sparkSession.sparkContext
    classes = context.broadcast(code_point_classes())
    words = frequent_words(rows, classes, added)
    lengths = _encode(library, words)
    short = [(w, n) for w, n in zip(words, lengths) if 0 < n < 256]
    table = context.broadcast(Lengths([w for w, _ in short], [n for _, n in short]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, _ = _load(tokenizer)
        cutter, first_tier, cache = PreTokens(classes.value, added), table.value, {}

        def misses(words: pa.Array) -> np.ndarray:
            found = pc.dictionary_encode(words)
            distinct = found.dictionary.to_pylist()
            if len(cache) > REMEMBERED:
                cache.clear()
            new = [w for w in distinct if w not in cache]
            cache.update(zip(new, _encode(library, new)))
            n = np.fromiter((cache[w] for w in distinct), np.int64, len(distinct))
            return n[found.indices.to_numpy()]

        for part, owner, pieces in _cut(batches, cutter):
            tokens = np.zeros(part.num_rows, np.int64)
            if pieces:
                raw, starts, of, whole = cutter(pieces)
                if len(starts):
                    size = np.diff(starts, append=len(raw))
                    n = first_tier.find(raw, starts, size)
                    missed = np.flatnonzero(n == 0)
                    if len(missed):
                        n[missed] = misses(_words(raw, starts).take(pa.array(missed)))
                    tokens += np.bincount(owner[of], n, part.num_rows).astype(np.int64)
                texts = [pieces[i].decode("utf-8", "replace") for i in np.flatnonzero(whole)]
                for i, e in zip(np.flatnonzero(whole), library.encode_batch_fast(texts, add_special_tokens=False)):
                    tokens[owner[i]] += len(e.ids)
            n_bytes = pc.binary_length(part.column("raw")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), n_bytes, pa.array(tokens)], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
