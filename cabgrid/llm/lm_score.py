"""Masked pseudo-likelihood scores of documents from a bidirectional window network trained in numpy.

Every word is predicted from the words on both sides of it; a document's score
is the sum of the conditional log-probabilities of all its words. The
vocabulary is every word of all documents with its count: the most frequent
words have ids of their own in the network, all others share hash buckets, and
a word of a bucket has its count's share of the bucket's probability. The
counts stay a table that is joined to the words. The network is embeddings of
the window, one hidden layer, and a softmax in two steps, class and word of the
class. Training is data-parallel: documents are dealt to shards of a bounded
number of words by a hash, a copy of the network is trained on masked positions
of each shard in a fixed order, and the copies' weighted mean starts the next
round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import checkpointed, slices

#: Weights travel as whole numbers of so much, so that their sums do not depend on their order.
UNIT = 1 << 24
#: Occurrences that a word of a bucket counts for if the documents trained on do not have it.
UNSEEN = 0.5


@dataclass(frozen=True)
class Settings:
    classes: int = 32  #: the vocabulary has classes ** 2 ids
    buckets: int = 128  #: ids that rare words share
    window: int = 3  #: words on each side
    embedding: int = 16
    hidden: int = 32
    masked: float = 0.5  #: part of the positions of every document that a round trains on, each round another while any are left
    rounds: int = 2
    step: float = 0.08
    batch: int = 4096
    shard: int = 1 << 21  #: words that a copy of the network is trained on, about
    known: int = 1 << 16  #: most frequent words whose counts each task holds at most; the others' are joined
    seed: int = 11

    @property
    def ids(self) -> int:
        return self.classes**2

    @property
    def id_type(self) -> np.dtype:
        return np.dtype("<u2" if self.ids < 1 << 16 else "<u4")


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9E3779B97F4A7C15


class Words:
    """Hashes of the words of texts, A-Z in lower case, computed for all words of a slice at once.

    A word's hash sums random values of its bytes times powers of an odd base,
    modulo 2**64.
    """

    def __init__(self):
        self.table = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.table[[9, 10, 11, 12, 13, 32]] = 0
        self._grow(1 << 18)

    def _grow(self, n: int) -> None:
        self.powers = np.cumprod(np.full(n, _BASE, np.uint64))
        self.inverse = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words per text, and the hashes of all of them."""
        parts = [x.as_buffer().to_pybytes() for x in texts]
        sizes = np.array([len(p) + 1 for p in parts])
        data = np.frombuffer(b" ".join([*parts, b""]).lower(), np.uint8)
        n = len(data)
        if n > len(self.powers):
            self._grow(2 * n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[:n], out=sums[1:])
        solid = np.zeros(n + 1, bool)
        solid[1:] = ~_SPACE[data]  # the last byte is a space
        turns = np.flatnonzero(solid[1:] != solid[:-1])
        starts, ends = turns[::2], turns[1::2]
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        h ^= h >> np.uint64(31)
        before = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
        return np.diff(before), h


class Ids:
    """Ids of words: the vocabulary's in its order, or a bucket for all others."""

    def __init__(self, vocabulary: list[int], settings: Settings):
        hashes = np.array(vocabulary, np.int64).view(np.uint64)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.first, self.buckets, self.words = settings.ids - settings.buckets, settings.buckets, Words()

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per text, and the ids and hashes of all of them."""
        counts, h = self.words(texts)
        ids = ((h >> np.uint64(20)) % np.uint64(self.buckets)).astype(np.int32) + self.first
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
            ids = np.where(self.sorted[at] == h, self.order[at], ids).astype(np.int32)
        return counts, ids, h

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of the words of each text."""
        counts, ids, _ = self.flat(texts)
        return np.split(ids, np.cumsum(counts)[:-1])


class Network:
    """The window network and its training by Adagrad."""

    def __init__(self, settings: Settings, flat: np.ndarray | None = None):
        s = self.settings = settings
        self.shapes = [
            (s.ids + 1, s.embedding), (2 * s.window * s.embedding, s.hidden), (s.hidden,),
            (s.hidden, s.classes), (s.classes,), (s.classes, s.hidden, s.classes), (s.classes, s.classes),
        ]
        if flat is None:
            rng = np.random.Generator(np.random.PCG64(s.seed))
            scale = [0.1, (2 * s.window * s.embedding) ** -0.5, 0, s.hidden**-0.5, 0, s.hidden**-0.5, 0]
            flat = np.concatenate([(rng.standard_normal(x) * k).ravel() for x, k in zip(self.shapes, scale)])
        self.flat = np.array(flat, np.float32)
        cuts = np.cumsum([int(np.prod(x)) for x in self.shapes])[:-1]
        self.parts = [x.reshape(shape) for x, shape in zip(np.split(self.flat, cuts), self.shapes)]
        self.seen = [np.full(x.shape, 1e-3, np.float32) for x in self.parts]

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        """Softmax of each column of ``z``, in place."""
        z -= z.max(axis=0)
        np.exp(z, out=z)
        z /= z.sum(axis=0)
        return z

    def _by_class(self, kind: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(kind.astype(np.uint16), kind="stable")
        cuts = np.searchsorted(kind[order], np.arange(self.settings.classes + 1))
        for c in np.flatnonzero(cuts[1:] > cuts[:-1]):
            yield int(c), order[cuts[c] : cuts[c + 1]]

    @staticmethod
    def _picked(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-softmax of each row of ``z`` at one place; overwrites ``z``."""
        z -= z.max()
        picked = z[np.arange(len(z)), at]
        return picked - np.log(np.exp(z, out=z).sum(axis=1) + np.float32(1e-30))

    def log_probabilities(self, line: np.ndarray) -> np.ndarray:
        """Log-probability of each id of a line given those around it; nothing for the id that stands for no word."""
        table, w1, b1, wc, bc, wm, bm = self.parts
        s = self.settings
        at = np.flatnonzero(line < s.ids)
        padded = np.full(len(line) + 2 * s.window, s.ids, np.int32)
        padded[s.window : s.window + len(line)] = line
        places = [*range(s.window), *range(s.window + 1, 2 * s.window + 1)]
        turned = [table @ w for w in np.split(w1, len(places))]  # what an id adds to the hidden layer at each place
        out = np.empty(len(at), np.float32)
        for k in range(0, len(at), 16384):
            here = at[k : k + 16384]
            h = np.repeat(b1[None], len(here), axis=0)
            for place, adds in zip(places, turned):
                h += adds.take(padded[here + place], axis=0)
            np.tanh(h, out=h)
            kind, member = np.divmod(line[here], s.classes)
            found = self._picked(h @ wc + bc, kind)
            for c, rows in self._by_class(kind):
                found[rows] += self._picked(h[rows] @ wm[c] + bm[c], member[rows])
            out[k : k + 16384] = found
        return out

    def train(self, context: np.ndarray, target: np.ndarray) -> None:
        """One step on a batch."""
        table, w1, b1, wc, bc, wm, bm = self.parts
        n = len(target)
        x = table.take(context, axis=0).reshape(n, -1)
        h = np.tanh(x @ w1 + b1)
        kind, member = np.divmod(target, self.settings.classes)
        d = self._softmax(wc.T @ h.T + bc[:, None])
        d[kind, np.arange(n)] -= 1
        d /= n
        grads = [np.zeros_like(p) for p in self.parts]
        grads[3], grads[4] = (d @ h).T, d.sum(axis=1)
        dh = (wc @ d).T.copy()
        for c, rows in self._by_class(kind):
            inner = h[rows]
            e = self._softmax(wm[c].T @ inner.T + bm[c][:, None])
            e[member[rows], np.arange(len(rows))] -= 1
            e /= n
            grads[5][c], grads[6][c] = (e @ inner).T, e.sum(axis=1)
            dh[rows] += (wm[c] @ e).T
        dh *= 1 - h * h
        grads[1], grads[2] = x.T @ dh, dh.sum(axis=0)
        dx = (dh @ w1.T).reshape(-1, self.settings.embedding)
        at = context.ravel()
        order = np.argsort(at.astype(self.settings.id_type), kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        grads[0][at[first]] = np.add.reduceat(dx.take(order, axis=0), first, axis=0)
        for p, g, v in zip(self.parts, grads, self.seen):
            v += g * g
            p -= self.settings.step * g / np.sqrt(v)


def _contexts(ids: np.ndarray, at: np.ndarray, settings: Settings) -> np.ndarray:
    """The ids around the places ``at``; beyond the ends stands the id after the last."""
    w = settings.window
    padded = np.full(len(ids) + 2 * w, settings.ids, np.int32)
    padded[w : w + len(ids)] = ids
    sides = np.array([*range(w), *range(w + 1, 2 * w + 1)])
    return padded[at[:, None] + sides]


def _drawn(raw: bytes, n: int, number: int, settings: Settings) -> np.ndarray:
    """The places of a text's ``n`` words that a round trains on."""
    rng = np.random.Generator(np.random.PCG64(xxhash.xxh3_64_intdigest(raw, settings.seed)))
    return np.flatnonzero((rng.random(n) - number * settings.masked) % 1 < settings.masked)


def _raw(docs: DataFrame, text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("raw")


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (its hash) and ``n`` of every word of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in slices(batches, "raw", 1 << 22):
            found = [np.empty(0, np.uint64)]
            found += [words(part.column("raw"))[1] for part in slices(iter([b]), "raw", 1 << 17)]
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["word", "n"])

    return docs.select(_raw(docs, text_col)).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, settings: Settings, text_col: str = "text", counts: DataFrame | None = None) -> list[int]:
    """Hashes of the most frequent words of all documents; as many as have ids of their own reach the driver."""
    counts = word_counts(docs, text_col) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(settings.ids - settings.buckets)
    return [r["word"] for r in top.collect()]


def shards(docs: DataFrame, words: list[int], settings: Settings, total: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``shard``, ``key``, ``copy``, ``ids``: the ids of the words of every text that has any, whole shards per partition, sorted.

    ``total`` words make ``total / settings.shard`` shards. A document is dealt by a
    hash of its id and text; rows that repeat both are counted first and dealt
    out one by one, so neither copies nor the layout of the input fill a shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(words, settings)
        for b in slices(batches, "raw", 1 << 17):
            lines = ids.of(b.column("raw"))
            rows = [i for i, line in enumerate(lines) if len(line)]
            found = pa.array([lines[i].astype(settings.id_type).tobytes() for i in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(rows, pa.int64())), found], ["key", "ids"])

    raw = _raw(docs, text_col)
    rows = docs.select(F.xxhash64(F.col(id_col).cast("string"), raw).alias("key"), raw.alias("raw")).mapInArrow(run, "key bigint, ids binary")
    rows = rows.groupBy("key", "ids").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("key", "ids", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    shard = F.pmod(F.xxhash64("key", "copy"), F.lit(max(1, -(-total // settings.shard))))
    rows = rows.select(shard.alias("shard"), "key", "copy", "ids").repartition("shard")
    return checkpointed(rows.sortWithinPartitions("shard", "key", "copy", "ids"))


def train(
    docs: DataFrame,
    words: list[int],
    settings: Settings,
    text_col: str = "text",
    id_col: str = "doc_id",
    counts: DataFrame | None = None,
) -> np.ndarray:
    """Weights after all rounds; a round trains on a seeded part of the positions of every document.

    The rounds' parts lie one after the other on a circle of seeded draws, so
    ``rounds * masked`` = 1 trains once on every position. Texts become ids
    once, in ``shards``; the same documents give the same weights however the
    input is cut into partitions. ``counts`` are the documents' ``word_counts``.
    """
    flat = Network(settings).flat
    counts = word_counts(docs, text_col) if counts is None else counts
    total = counts.agg(F.sum("n")).first()[0] or 0
    dealt = shards(docs, words, settings, total, id_col, text_col)

    def trained(flat: np.ndarray, number: int):
        def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            """Shard, contexts and targets of each document."""
            for b in batches:
                keys, shard, copy = (b.column(c).to_pylist() for c in ("key", "shard", "copy"))
                for at, x in enumerate(b.column("ids")):
                    doc = np.frombuffer(x.as_buffer(), settings.id_type).astype(np.int32)
                    places = _drawn(b"%d %d" % (keys[at], copy[at]), len(doc), number, settings)
                    yield shard[at], _contexts(doc, places, settings), doc[places]

        def one(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            network, held, n, done = Network(settings, flat), [], 0, 0
            for _, context, target in parts:
                held.append((context, target))
                n += len(target)
                if n >= settings.batch:
                    context, target = (np.concatenate(v) for v in zip(*held))
                    whole = n - n % settings.batch
                    for s in range(0, whole, settings.batch):
                        network.train(context[s : s + settings.batch], target[s : s + settings.batch])
                    held, done, n = [(context[whole:], target[whole:])], done + whole, n - whole
            if n:
                network.train(*(np.concatenate(v) for v in zip(*held)))
            weight = 1 + (done + n) // 1024
            sums = np.round(network.flat.astype(np.float64) * UNIT).astype(np.int64) * weight
            columns = [pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums), pa.array(np.full(len(sums), weight))]
            return pa.RecordBatch.from_arrays(columns, ["at", "part", "weight"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, parts in groupby(copies(batches), itemgetter(0)):
                yield one(parts)

        return run

    for number in range(settings.rounds):
        sums = dealt.mapInArrow(trained(flat, number), "at int, part bigint, weight bigint")
        means = sums.groupBy("at").agg((F.sum("part") / F.sum("weight") / UNIT).alias("mean"))
        found = means.toArrow()
        flat = flat.copy()
        flat[found.column("at").to_numpy()] = found.column("mean").to_numpy()
    return flat


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the most frequent words, at most ``most`` of them.

    Words are taken by bands of their counts, a sixteenth of a power of two
    wide: the number of words of each band reaches the driver first, then the
    words of the upper bands that hold no more than ``most`` together.
    """
    band = F.floor(F.log2("n") * 16)
    taken, least = 0, None
    for r in sorted(counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["band"]):
        taken += r["words"]
        if taken > most:
            break
        least = r["band"]
    found = counts.where(band >= least if least is not None else F.lit(False)).toArrow()
    hashes, n = found.column("word").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n[order]


def _totals(counts: DataFrame, words: list[int], settings: Settings) -> np.ndarray:
    """Occurrences of the words of each bucket; one number per bucket reaches the driver."""
    bucket = F.shiftrightunsigned("word", 20) % settings.buckets
    found = counts.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(settings.buckets, np.int64)
    for r in found:
        totals[r["bucket"]] = r["n"]
    for r in counts.where(F.col("word").isin(words)).collect() if words else []:
        totals[((r["word"] % (1 << 64)) >> 20) % settings.buckets] -= r["n"]
    return totals


def score(
    docs: DataFrame,
    words: list[int],
    flat: np.ndarray,
    settings: Settings,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: DataFrame | None = None,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``log_likelihood``, ``mean_log_likelihood`` (null without words) per row of ``docs``.

    With ``counts`` (``word_counts`` of the documents trained on) a word of a
    bucket has its bucket's probability times its share of the bucket's
    occurrences; a word that is not in the table counts as half an occurrence,
    which every bucket has to spare. Tasks look up the ``settings.known`` most
    frequent words by themselves; any other bucket word of a document is a row
    that meets its count by the word's hash. Without ``counts`` such words have
    the probability of the whole bucket.
    """
    shared = counts is not None
    totals = np.log(_totals(counts, words, settings) + UNSEEN) if shared else None
    known, times_known = frequent(counts, settings.known) if shared else (np.empty(0, np.uint64), np.empty(0, np.int64))
    logs_known = np.log(times_known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, ids = Network(settings, flat), Ids(words, settings)
        row = TaskContext.get().partitionId() << 33
        for b in slices(batches, "raw", 1 << 17):
            lengths, found_ids, hashes = ids.flat(b.column("raw"))
            docs = np.split(found_ids, np.cumsum(lengths)[:-1])
            gap = np.full(settings.window, settings.ids, np.int32)
            found = network.log_probabilities(np.concatenate([v for d in docs for v in (d, gap)]))
            at = np.flatnonzero(found_ids >= ids.first) if shared else np.empty(0, np.int64)
            found = found.astype(np.float64)
            if shared:
                found[at] -= totals[found_ids[at] - ids.first]
                if len(known):
                    place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
                    met = known[place] == hashes[at]
                    found[at[met]] += logs_known[place[met]]
                    at = at[~met]
            sums = np.concatenate([[0.0], np.cumsum(found)])
            ends = np.cumsum(lengths)
            n, keys = len(lengths), row + np.arange(len(lengths))
            row += n
            # a row per document, under a word of its own that counts no times, and one per other bucket word of it
            owner, h = np.repeat(np.arange(n), lengths)[at], hashes[at]
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), bool), (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])]))
            times = np.diff(np.append(first, len(h)))
            own = keys.astype(np.uint64) * np.uint64(_BASE)
            nulls = pa.nulls(len(first), pa.int64()), pa.nulls(len(first), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([keys, keys[owner[first]]])),
                    pa.array(np.concatenate([own, h[first]]).view(np.int64)),
                    pa.array(np.concatenate([np.zeros(n, np.int64), times])),
                    pa.concat_arrays([b.column("id"), pa.nulls(len(first), b.column("id").type)]),
                    pa.concat_arrays([pa.array(lengths, pa.int64()), nulls[0]]),
                    pa.concat_arrays([pa.array(sums[ends] - sums[ends - lengths]), nulls[1]]),
                ],
                ["row", "word", "times", "id", "n_words", "likelihood"],
            )

    schema = f"row bigint, word bigint, times bigint, id {docs.schema[id_col].dataType.simpleString()}, n_words bigint, likelihood double"
    rows = docs.select(F.col(id_col).alias("id"), _raw(docs, text_col)).mapInArrow(run, schema)
    total = F.col("likelihood")
    if shared:
        part = lambda n: F.round(F.log(n) * UNIT).cast("long")
        logs = counts.select(F.col("word").alias("seen"), part(F.col("n")).alias("part"))
        rows = (
            rows.join(logs, F.col("word") == F.col("seen"), "left")
            .groupBy("row")
            .agg(
                F.max("id").alias("id"),
                F.max("n_words").alias("n_words"),
                F.max("likelihood").alias("likelihood"),
                F.sum(F.col("times") * F.coalesce("part", part(F.lit(UNSEEN)))).alias("parts"),
            )
        )
        total = total + F.col("parts") / UNIT
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        total.alias("log_likelihood"),
        F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_likelihood"),
    )


def lm_scores(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Trains on all documents and scores each of them: see ``vocabulary``, ``train`` and ``score``.

    Words are runs of characters that are not ASCII white space, A-Z in lower
    case. Null and empty texts have no words, the score 0 and the mean null;
    rows that repeat an id are scored each; an empty table gives an empty
    result. The order and the partitions of the input change no more than the
    last digits. To score other documents than those trained on, call the
    steps. The driver holds the words with ids of their own, the counts of the
    ``known`` most frequent ones and the weights, whose sizes ``Settings``
    bounds; the counts of all words are a table.
    """
    counts = checkpointed(word_counts(docs, text_col))
    words = vocabulary(docs, settings, text_col, counts)
    return score(docs, words, train(docs, words, settings, text_col, id_col, counts), settings, id_col, text_col, counts)
