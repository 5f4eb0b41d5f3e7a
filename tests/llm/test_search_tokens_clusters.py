"""Lexical search, token counts and centroid clustering against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cabgrid.llm import centroids, lexical_search, token_counts
from cabgrid.llm.queries import QUERIES
from cabgrid.llm.sql import ORACLE_SQL
from compare import compare, duck
from conftest import SF_SMALL

BPE = public_tokenizers.path("byte_bpe_50k.json")
RNG = np.random.default_rng(5)
WORDS = ["the", "of", "and", *("".join(RNG.choice(list("abcdefgé"), 5)) for _ in range(120))]
ODD = [None, "", " \n\t", "x", "don't they'll we'Re 's ''s 'm", "a  b\n\n c 　d  e", "<|endoftext|> a <|endoftext|>"]
ODD += ["日本語 のテキスト", "emoji 😀😀 x", "\u0085\x1c y", "12 345x 6.7", "'tis 'til 'll'd'", "a" * 3000, "The THE the", "ǅ Ⅷ ½ ²"]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*ODD, *(prose(60, s) for s in range(20)), prose(60, 0), prose(60, 0), prose(9000, 77)]
    rows = [(i, t, "r", 1, "x") for i, t in enumerate(texts)]
    rows += [rows[20], (None, prose(30, 1), "r", 1, "x"), (None, prose(30, 2), "", None, None), (3, prose(30, 3), "", 2, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, raw string, n long, id string").repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, prose(12, 100 + i)) for i in range(12)] + [(20, None), (21, ""), (22, "zzzz"), (23, "the the THE of"), (23, "The")]
    rows += [(None, prose(12, 100)), (24, prose(12, 100) + " of"), (25, prose(12, 100)[: len(prose(12, 100)) // 2])]
    return spark.createDataFrame(rows, "item_id long, text string")


# --- lexical search ------------------------------------------------------------


def terms_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_search(docs, items, k):
    tfs = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in tfs if c), sum(c.total() for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in tfs:
            m = 10 + 90 * c.total() * n_docs // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms_of(text))
                if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("block, documents, k", [(200_000, 4096, 10), (60, 5, 3)])
def test_search_equals_plain(docs, items, monkeypatch, block, documents, k):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "DOCUMENTS", documents)
    found = lexical_search.search(docs, items, k).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    expected = plain_search(texts, [tuple(r) for r in items.collect()], k)
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found) == expected


def test_search_shares_what_items_have_in_common():
    lists = [["a", "b", "c", "d"], ["a", "b", "c", "e"], ["a", "b", "f"], ["g"], ["a", "b"]]
    plan = lexical_search.SharedPlan(lists)
    by_class = {}
    for t, c in zip(plan.terms, plan.class_of.tolist()):
        by_class.setdefault(c, []).append(t)
    assert by_class[plan.class_of[plan.terms.index("a")]] == ["a", "b"]  # the same items hold both
    assert sum(len(c) for _, c, _ in plan.steps) == 6  # ab, c, d, e, f, g: each worked out once
    levels, got = [[]], {}
    for depth, classes, done in plan.steps:
        levels[depth + 1 :] = [levels[depth] + [t for c in classes for t in by_class[c]]]
        got |= {i: sorted(levels[depth + 1]) for i in done}
    assert got == {i: sorted(x) for i, x in enumerate(lists)}


def test_search_cuts_long_texts(spark, monkeypatch):
    text = prose(700_000, 9)  # longer than a piece
    docs = spark.createDataFrame([(1, text), (2, "the")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the of"), (2, text[:40])], "item_id long, text string")
    found = lexical_search.search(docs, items).collect()
    expected = plain_search([(1, text), (2, "the")], [(1, "the of"), (2, text[:40])], 10)
    assert Counter(tuple(r) for r in found) == expected


def test_search_of_empty_tables(docs, items):
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs, items.where("item_id = 21")).count() == 0


# --- token counts ----------------------------------------------------------------


def plain_counts(texts):
    return [len(e.ids) for e in Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("frequent, fan_in", [(1 << 15, 32), (4, 2), (0, 2)])
def test_token_counts_equal_the_library(docs, monkeypatch, frequent, fan_in):
    monkeypatch.setattr(token_counts, "FREQUENT", frequent)
    monkeypatch.setattr(token_counts, "FAN_IN", fan_in)
    monkeypatch.setattr(token_counts.frequent_words, "__defaults__", (frequent,))
    found = token_counts.count_tokens(docs, BPE).collect()
    rows = docs.select("doc_id", "text").collect()
    texts = [r["text"] or "" for r in rows]
    n_bytes = [len(t.encode()) for t in texts]
    expected = Counter((r["doc_id"], b, n, n > 1024) for r, b, n in zip(rows, n_bytes, plain_counts(texts)))
    assert Counter(tuple(r) for r in found) == expected


def test_pre_tokens_of_random_texts():
    classes = token_counts.code_point_classes()
    cutter = token_counts.PreTokens(classes, [b"<|endoftext|>"])
    library, _ = token_counts._load(BPE)
    signs = list(" \n\t'strevmld.,!9²aZé日") + ["  ", "'s", "'ll", " ", "　", "́", "😀", "ª", "​", "­"]
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(signs, rng.integers(1, 30))) for _ in range(3000)]
    raw, starts, of, left_out = cutter([t.encode() for t in texts])
    ends = np.append(starts[1:], len(raw))
    got = [[] for _ in texts]
    for s, e, i in zip(starts, ends, of):
        got[i].append(raw[s:e].tobytes().decode())
    assert left_out.sum() < 300
    for i, text in enumerate(texts):
        if not left_out[i]:
            pieces = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert got[i] == pieces, repr(text)


def test_code_points_by_the_tokenizer():
    """Every undisputed code point of the basic plane joins letters, digits or blanks as the tokenizer has it."""
    classes = token_counts.code_point_classes()
    points = [c for c in range(0x10000) if classes[c] != token_counts._UNSURE and not 0xD800 <= c < 0xE000]
    assert len(points) > 45_000
    library, _ = token_counts._load(BPE)
    cutter = token_counts.PreTokens(classes, [])
    for pattern in ("a{}1", "一{} x", "!{}  b"):
        texts = [pattern.format(chr(c)) for c in points]
        raw, starts, of, _ = cutter([t.encode() for t in texts])
        mine = np.bincount(of, minlength=len(texts))
        for t, n in zip(texts, mine):
            assert len(library.pre_tokenizer.pre_tokenize_str(t)) == n, repr(t)


def test_long_texts_are_cut_where_tokens_start(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE", 64)
    texts = [prose(400, 1) + "  \n\n 's a's", "x" * 500 + " " * 90 + "y z", "日本 " * 80, "a　 b" * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, BPE).collect()}
    assert found == dict(enumerate(plain_counts(texts)))


def test_token_counts_of_an_empty_table(docs):
    found = token_counts.count_tokens(docs.limit(0), BPE)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and found.count() == 0


def test_frequent_table_finds_each_word():
    words = [b"a", b" a", b"a\0", b"\0", b"abcdefghijklmno", "é".encode(), b"abcdefgh", b"abcdefg"]
    table = token_counts.Lengths(words, list(range(1, 9)))
    asked = [*words, b"b", b"abcdefghijklmnop", b"abcdefghi"]
    n = np.array([len(w) for w in asked])
    found = table.find(np.frombuffer(b"".join(asked), np.uint8), np.cumsum(n) - n, n)
    assert found.tolist() == [*range(1, 9), 0, 0, 0]


def test_no_shuffle_of_pre_tokens(docs):
    plan = token_counts.count_tokens(docs.select("doc_id", "text"), BPE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1  # the fixture's own repartition


# --- centroids -----------------------------------------------------------------


def vectors_frame(spark, n=300, size=64, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, size)) + rng.normal(0, 0.4, (9, size))[rng.integers(0, 9, n)]
    rows = [(i, [float(v) for v in np.float32(r)], "label", 1) for i, r in enumerate(x)]
    rows += [(1000 + i, rows[i][1], "copy", 1) for i in range(min(n, 40))] + [rows[5]]
    bad = [None, [], [0.5] * 63, [0.5] * 65, [None] + [0.5] * 63, [math.nan] + [0.5] * 63, [math.inf] + [0.5] * 63, [1e30] + [0.0] * 63]
    rows += [(2000 + i, v, "bad", 0) for i, v in enumerate(bad)] + [(None, [0.25] * 64, "no id", 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, distance long").repartition(4)


def plain_clusters(rows, k, rounds, size=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and abs(x) <= 2.0**19 for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, _, v in sorted((name(i), v, v) for i, v in kept)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, vs in groups.items():
            centres[j] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, inertia[j], inertia.total(), digest[j]) for i, d, j in found)


@pytest.mark.parametrize("k, rounds", [(40, 5), (3, 2), (1, 1), (700, 1)])
def test_clusters_equal_plain(spark, k, rounds):
    frame = vectors_frame(spark, 200)
    found = centroids.cluster_vectors(frame, k, rounds).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in frame.select("vec_id", "embedding").collect()]
    assert Counter(tuple(r) for r in found) == plain_clusters(rows, k, rounds)


def test_orchard_search_passes_over_centroids():
    rng = np.random.default_rng(8)
    centres = rng.integers(-50, 50, (200, 2))
    centres[17] = centres[3]  # a tie: the smaller number wins
    x = rng.integers(-60, 60, (500, 2))
    best, distance = centroids.Orchard(centres).nearest(x)
    every = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_clusters_of_empty_and_unusable_tables(spark):
    frame = vectors_frame(spark, 10)
    for part in (frame.limit(0), frame.where("cluster = 'bad'")):
        out = centroids.cluster_vectors(part)
        assert out.count() == 0 and out.columns[:3] == ["vec_id", "cluster", "distance"]


@pytest.mark.parametrize("key", ["op11_lexical_search", "op13_centroids"])
def test_queries_equal_sql(spark, key):
    ok, why = compare(QUERIES[key](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[key])
    assert ok, why


def test_token_query_covers_its_table(spark):
    out = QUERIES["op12_token_counts"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.collect()
    expected = dict(zip((r["doc_id"] for r in rows), plain_counts([r["text"] for r in rows])))
    assert {r["doc_id"]: r["n_tokens"] for r in out.collect()} == expected
