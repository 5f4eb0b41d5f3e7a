"""Packing token pieces into sequences: vector bin packing by the dot-product heuristic.

An item asks for tokens, segments and loss-bearing tokens; a sequence has a
capacity in each. The next item of a sequence is the one of a small pool whose
demand has the largest dot product with what the sequence has left, both
measured in capacities. When nothing fits, the item with the largest product
is cut at the room left. Tasks pack what Spark's scan deals to them, apart
from each other.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import slices

#: Items that wait for a sequence at a time.
POOL = 256
#: Words a task remembers the ids of before it starts anew.
MEMORY = 600_000


#: Classes of bytes as the tokenizer's pre-tokenizer sees them in plain texts.
_LETTER, _DIGIT, _SPACE, _OTHER_SPACE, _OTHER = range(5)
#: Plain texts have no two white-space characters in a row, no apostrophes, and beyond ASCII Latin letters only.
_NOT_PLAIN = r"[\s\v\x{1c}-\x{1f}]{2}|'|[^\x{0}-\x{7f}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]"


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[0x80:] = _LETTER
    for chars, kind in ((b"\t\n\v\f\r", _OTHER_SPACE), (b" ", _SPACE), (b"0123456789", _DIGIT)):
        kinds[list(chars)] = kind
    kinds[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
    return kinds


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: itself if printable, else the next one from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Tokens:
    """Ids of whole texts by a byte-level BPE file of the ``tokenizers`` library, through a memory of words.

    The tokenizer cuts text at changes between letters, digits, other signs
    and white space (a space goes with what follows) before it merges bytes.
    Plain texts are cut so in numpy, and each distinct word is encoded once;
    all other texts, and those that hold the content of an added token of the
    file, are encoded whole.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.not_plain = "|".join([_NOT_PLAIN, *added])
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known: dict[bytes, bytes] = {}
        self.kinds = _byte_classes()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _word(self, word: bytes) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.letters))]).tobytes()

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        plain = pc.invert(pc.match_substring_regex(texts, self.not_plain)).to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        odd = np.flatnonzero(~plain)
        for i, ids in zip(odd, self._whole([texts[int(i)].as_py() for i in odd])):
            out[i] = ids
        rows = np.flatnonzero(plain)
        parts = [texts[int(i)].as_buffer() for i in rows]
        rows, parts = rows[[len(x) > 0 for x in parts]], [x for x in parts if len(x)]
        if not parts:
            return out
        raw = np.frombuffer(b"".join(parts), np.uint8)
        firsts = np.cumsum([0, *map(len, parts)])[:-1]
        kind = self.kinds[raw]
        cut = np.empty(len(raw), bool)
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut[1:] &= kind[:-1] != _SPACE
        cut[firsts] = True
        starts = np.flatnonzero(cut)
        offsets = pa.py_buffer(np.append(starts, len(raw)).astype(np.int32))
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(raw)])
        flat = pc.dictionary_encode(words)
        found = self._words(flat.dictionary.to_pylist())
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), np.uint32)
        begin = np.cumsum(length) - length
        index = flat.indices.to_numpy()
        n = length[index]
        ends = np.cumsum(n)
        ids = pool[np.repeat(begin[index] - ends + n, n) + np.arange(ends[-1])]
        for row, part in zip(rows, np.split(ids, ends[np.searchsorted(starts, firsts[1:]) - 1])):
            out[row] = part
        return out

    def _words(self, words: list[bytes]) -> list[bytes]:
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        return [known.get(w) or known.setdefault(w, self._word(w)) for w in words]


class Packer:
    """Packs the items of one task; ``add`` and ``flush`` yield (item, start, length, sequence, offset)."""

    def __init__(self, tokens: int, segments: int, loss: int):
        self.capacity = tokens, segments, loss
        self.items: list[tuple] = [()] * POOL
        self.tokens, self.loss = np.full(POOL, np.inf), np.zeros(POOL)  # demands; an empty place asks for too much
        self.free = list(range(POOL))
        self.sequence = 0
        self._open()

    def _open(self) -> None:
        self.room = self.capacity
        self.pieces: list[tuple] = []

    def _close(self) -> Iterator[tuple]:
        """The open sequence: whole if it is full, else as sequences whose lengths are powers of two."""
        left = sum(p[2] for p in self.pieces)
        size = left if left == self.capacity[0] or not left else 1 << (left.bit_length() - 1)
        offset = 0
        for item, start, length in self.pieces:
            while length:
                n = min(length, size - offset)
                yield item, start, n, self.sequence, offset
                start, length, offset, left = start + n, length - n, offset + n, left - n
                if offset == size:
                    self.sequence, offset = self.sequence + 1, 0
                    size = 1 << (left.bit_length() - 1) if left else 0
        self._open()

    def _put(self, slot: int, item, start: int, end: int, loss: np.ndarray | None) -> None:
        self.items[slot] = item, start, end, loss
        self.tokens[slot] = end - start
        self.loss[slot] = end - start if loss is None else loss[end] - loss[start]

    def add(self, item, n: int, loss: np.ndarray | None = None) -> Iterator[tuple]:
        """An item of ``n`` tokens; ``loss`` is the running count of loss-bearing ones from 0 on (None: all are)."""
        start, whole = 0, self.capacity[0]
        while n - start >= whole and (whole if loss is None else loss[start + whole] - loss[start]) <= self.capacity[2]:
            yield item, start, whole, self.sequence, 0  # fills a sequence by itself
            start, self.sequence = start + whole, self.sequence + 1
        if start < n:
            self._put(self.free.pop(), item, start, n, loss)
        while not self.free:
            yield from self._place()

    def flush(self) -> Iterator[tuple]:
        while len(self.free) < POOL:
            yield from self._place()
        yield from self._close()

    def _place(self) -> Iterator[tuple]:
        room, segments, loss_room = self.room
        whole, _, loss_whole = self.capacity
        score = self.tokens * (room / whole**2) + self.loss * (loss_room / loss_whole**2)  # a segment adds the same to all
        fits = (self.tokens <= room) & (self.loss <= loss_room)
        if segments == 1:  # the last segment should fill the sequence
            fits &= self.tokens == room
        slot = int(np.where(fits, score, -1.0).argmax())
        if not fits[slot]:
            slot = int(np.where(self.tokens < np.inf, score, -1.0).argmax())
        item, start, end, loss = self.items[slot]
        n = min(end - start, room)
        if loss is None:
            cost = n = min(n, loss_room)
        else:
            n = min(n, int(np.searchsorted(loss, loss[start] + loss_room, "right")) - 1 - start)
            cost = int(loss[start + n] - loss[start])
        if n:
            self.pieces.append((item, start, n))
            self.room = room - n, segments - 1, loss_room - cost
        if start + n == end:
            self.tokens[slot], self.loss[slot] = np.inf, 0
            self.free.append(slot)
        elif n:
            self._put(slot, item, start + n, end, loss)
        if not n or not self.room[0] or not self.room[1]:
            yield from self._close()


def pack(
    docs: DataFrame,
    tokenizer: str,
    tokens: int = 1024,
    segments: int = 64,
    loss_tokens: int | None = None,
    loss: Callable[[str, np.ndarray], np.ndarray] | None = None,
    end_id: int = 0,
    added_tokens: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents, packed: ``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is the ids of its text by the ``tokenizers`` file ``tokenizer``
    and then ``end_id``; ``ids`` holds a piece's ids as little-endian unsigned
    32-bit numbers. With ``added_tokens`` the content of an added token in a
    text is that token's id, as in the file's own encoding; without it, such
    content is cut as any other text. A sequence has at most ``tokens`` tokens, ``segments``
    pieces and ``loss_tokens`` (default: ``tokens``) loss-bearing tokens; its
    pieces lie gapless from offset 0. ``loss(text, ids)`` returns a flag for
    each id; without it every token bears loss. Sequences that cannot be
    filled are laid out as sequences of a power of two of tokens, so nothing
    is padded. Every id lies in one piece.

    A null or empty text is ``end_id`` alone; rows that repeat an id or have
    none are documents of their own; documents of any length are cut. An empty
    table gives no pieces. A task holds a pool of ``POOL`` documents and one
    batch of input. Ids of sequences hold the task's partition number, so a
    repeated task gives the same ones.
    """
    limit = tokens if loss_tokens is None else loss_tokens
    if min(tokens, segments, limit) < 1:
        raise ValueError("capacities must be at least 1")
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = Tokens(tokenizer, added_tokens), Packer(tokens, segments, limit)
        base = TaskContext.get().partitionId() << 33

        def table(pieces: list[tuple]) -> pa.RecordBatch:
            rows = [
                (item[0], start, n, item[1][start : start + n].tobytes(), len(item[1]), base + sequence, offset)
                for item, start, n, sequence, offset in pieces
            ]
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        id_type = pa.int64()
        for whole in batches:
            for b in slices(iter([whole]), "text", 1 << 23):
                id_type = b.column("id").type
                pieces: list[tuple] = []
                for key, text, ids in zip(b.column("id").to_pylist(), b.column("text"), encode(b.column("text"))):
                    ids = np.append(ids, np.uint32(end_id))
                    flags = None if loss is None else np.concatenate([[0], np.cumsum(loss(text.as_py(), ids))])
                    pieces += packer.add((key, ids), len(ids), flags)
                if pieces:
                    yield table(pieces)
        if pieces := list(packer.flush()):
            yield table(pieces)

    id_type = docs.schema[id_col].dataType.simpleString()
    text: Column = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (
        docs.select(F.col(id_col).alias("id"), text.alias("text"))
        .mapInArrow(run, f"id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
        .withColumnRenamed("id", id_col)
    )
