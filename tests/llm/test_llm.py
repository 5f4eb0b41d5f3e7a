"""Each training-data operator against a brute-force version, and on nulls, empty and long texts, ties and empty tables."""

from __future__ import annotations

import collections
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cabgrid.llm import chat, chunk_dedup, embed_dedup, lm_score, mixing, packing, quality, simhash, suffix_dedup, warc
from cabgrid.llm.common import components, keyed
from cabgrid.llm.queries import QUERIES
from cabgrid.llm.sql import ORACLE_SQL
from cabgrid.session import scratch_path
from compare import compare
from conftest import SF_SMALL

RNG = np.random.default_rng(1)
WORDS = ["the", "of", "and", *("".join(RNG.choice(list("abcdefgé"), 6)) for _ in range(300))]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, raw string, th int"


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


PASSAGE = prose(70, 99)
ODD = [None, "", " \n\t", "x", prose(6000, 1005), "a " * 400, "é" * 500, "\u3000 a\u00a0b  c\r\n'd <|endoftext|>"]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, copies, shared passages, repeated rows, null ids and sources, and columns with clashing names."""
    texts = [*ODD, *(prose(120, s) for s in range(10)), prose(120, 0), prose(120, 0) + " more"]
    texts += [f"{prose(40, 50 + s)}\n{PASSAGE}\n{prose(40, 70 + s)}" for s in range(6)]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 1, 7, "r", 3) for i, t in enumerate(texts)]
    rows += [rows[9], (None, prose(90, 33), None, None, None, None, None, None), (3, prose(80, 34), None, "s0", 1, 1, "", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def raws(docs):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]


def key(i, raw):
    return (-1 if i is None else i, hashlib.sha256(raw).hexdigest())


@pytest.mark.parametrize("part", [1024, 2])
def test_repeats_equal_brute_force(docs, monkeypatch, part):
    monkeypatch.setattr(suffix_dedup, "PART", part)
    rows = raws(docs)
    count = collections.Counter(b[k : k + 200] for _, b in rows for k in range(len(b) - 199))
    want = []
    for i, b in rows:
        gone = np.zeros(len(b) + 2, bool)
        for k in range(len(b) - 199):
            gone[k + 1 : k + 201] |= count[b[k : k + 200]] > 1
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]]) if b else b""
        spans = int((gone[1:] & ~gone[:-1]).sum())
        want.append((-1 if i is None else i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((-1 if r[0] is None else r[0], r["n_bytes"], r["n_removed"], len(r["spans"]), r["sha256"]) for r in got) == sorted(want)
    assert sum(w[2] > 0 for w in want) >= 8


def test_packing_covers_every_id_once(docs, spark):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), segments=3).collect()
    want = collections.Counter()
    for _, raw in raws(docs):
        want.update([tuple(tok.encode(raw.decode(), add_special_tokens=False).ids) + (0,)])
    parts, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert r["length"] * 4 == len(r["ids"]) and r["length"] > 0
        parts[(r["doc_id"], r["doc_tokens"])].append((r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert len(pieces) <= 3 and (end == 1024 or end & (end - 1) == 0)
    assert sum(n for p in sequences.values() for _, n in p) == sum(len(k) * n for k, n in want.items())
    for (i, n), pieces in parts.items():
        if i not in (None, 1, 3, 9):  # the ids that one row has
            ids = [x for _, part in sorted(pieces) for x in part]
            assert len(ids) == n and want[tuple(ids)] >= 1


def test_packing_gives_added_tokens_their_ids(spark):
    """The ids of the file's tokenizer as it is, in the query and in the pipeline's stage, for plain and other texts."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "it's  so <|endoftext|>\n\né", "a <|endoftext| b", prose(50, 7)]
    assert tok.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    path = scratch_path(spark, "added-tokens")
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{path}/documents.parquet")
    for out in (QUERIES["op2_packing"](spark, path), corpus_pipeline.pack_tokens(spark, table, path)):
        got = out.collect()
        assert {r["doc_id"] for r in got} == set(range(len(texts)))
        for r in got:
            ids = np.array([*tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())


def test_packer_keeps_every_limit():
    rng = np.random.default_rng(3)
    packer = packing.Packer(64, 4, 20)
    sizes, out = rng.integers(1, 200, 400), []
    flags = [np.concatenate([[0], np.cumsum(rng.random(n) < 0.4)]) for n in sizes]
    for i, n in enumerate(sizes):
        out += packer.add(i, int(n), flags[i])
    out += packer.flush()
    by = collections.defaultdict(list)
    for item, start, n, sequence, _ in out:
        by[sequence].append((n, flags[item][start + n] - flags[item][start]))
    assert all(sum(n for n, _ in p) <= 64 and len(p) <= 4 and sum(x for _, x in p) <= 20 for p in by.values())
    assert sum(n for p in by.values() for n, _ in p) == sizes.sum()


def test_warc_round_trip(spark):
    rows = [(i, f"http://h/{i}", html) for i, html in enumerate([None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "é\r\n\r\nWARC/1.1\r\n" * 30])]
    rows += [(7, None, "y" * 100), (8, "http://a\r\nb", "é\r\n\r\nWARC/1.1\r\n" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path, archives=3)
    found = warc.read_records(spark, path)
    assert found.count() == 3 * len(rows)
    got = {int(r["capture_id"].split(":")[-2]): r for r in warc.transactions(found).collect()}
    for i, _, html in rows:
        r, raw = got[i], (html or "").encode()
        a = r["response"]
        assert (a["payload_bytes"], a["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert a["record_type"] == ("revisit" if i in (5, 7, 8) else "response")
        assert (bytes(a["payload"]) == raw) == (a["record_type"] == "response")
        name = f":{i}:{hashlib.sha256(raw).hexdigest()[:32]}"
        assert r["request"]["record_id"].endswith(name) and r["metadata"]["record_id"].endswith(name)
    assert got[7]["response"]["refers_to"] == got[4]["capture_id"] and got[8]["response"]["refers_to"] == got[6]["capture_id"]
    warc.write_archives(pages.limit(0), scratch_path(spark, "warc-empty"))
    orphan = found.where("record_type <> 'metadata'").unionByName(found.where("record_type = 'request'"))
    assert {r["metadata"] for r in warc.transactions(orphan).collect()} == {None}


def test_warc_repeated_and_missing_ids(spark, monkeypatch):
    """One capture per id and payload; null ids, empty tables and columns with the names of the operator's own."""
    big, other = "y" * 120, "z" * 120
    rows = [(1, "http://b/", big), (1, "http://b/", big), (1, "http://a/", big), (1, "http://b/", other), (2, None, other)]
    rows += [(None, "http://n/", big), (None, "http://n/", other), (None, "http://n/", None), (None, "http://n/", None), (3, "http://c/", "")]
    pages = spark.createDataFrame([(*r, "x", "y", 5) for r in rows], "page_id long, url string, html string, name string, digest string, first int")
    path = scratch_path(spark, "warc-repeats")
    pages.write.parquet(f"{path}/pages.parquet")
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = sorted(
        [(1, sha(big), "response", None), (1, sha(other), "response", None), (2, sha(other), "revisit", 1), (3, sha(""), "response", None),
         (-1, sha(big), "revisit", 1), (-1, sha(other), "revisit", 1), (-1, sha(None), "response", None)], key=str
    )
    got = QUERIES["op3_warc"](spark, path).collect()
    each = [(-1 if r["page_id"] is None else r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(each, key=str) == want
    assert len({r["request_id"] for r in got}) == len({r["metadata_id"] for r in got}) == len(want)
    out = scratch_path(spark, "warc-repeats")
    warc.write_archives(pages, out)
    found = warc.transactions(warc.read_records(spark, out)).collect()
    uris = {r["capture_id"]: (r["response"]["target_uri"], r["request"]["target_uri"], r["metadata"]["target_uri"]) for r in found}
    assert uris[f"urn:capture:response:1:{sha(big)[:32]}"] == ("http://a/",) * 3  # of several targets the smallest
    limited = scratch_path(spark, "warc-limited")
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)  # two captures of 120 bytes, or a little more
    many = spark.createDataFrame([(i % 40, "http://m/", f"{i // 2:0120d}") for i in range(80)], "page_id long, url string, html string")
    warc.write_archives(many.coalesce(1), limited)
    archives = spark.read.format("binaryFile").load(limited).select("content").collect()
    assert max(zlib.decompress(bytes(r[0]), 47).count(b"WARC-Type: ") for r in archives) == 6
    assert warc.transactions(warc.read_records(spark, limited)).count() == 80
    none = scratch_path(spark, "warc-none")
    pages.limit(0).write.parquet(f"{none}/pages.parquet")
    assert QUERIES["op3_warc"](spark, none).count() == 0


def test_quality_rules(docs, empty, spark):
    got = quality.quality(docs).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] not in (None, 1, 3)}
    assert by[0]["base_failed"] and by[5]["n_repeat_words"] == 400 and not by[5]["kept"] and by[9]["kept"]
    assert quality.quality(empty).count() == 0
    words = [str(x).encode() for x in np.random.default_rng(4).integers(0, 3, 80)]
    at = collections.defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    want = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    assert quality.repeated_words(words) == len(want)
    # a line in most documents of a host goes; its copies in one repeated document do not count
    menu = "home about contact login imprint privacy terms cookies jobs press help"
    rows = [(i, menu if i < 5 else f"{menu}\n{prose(40, 200 + i)}", "h") for i in range(40)] + [(90 + i, prose(30, 7), "g") for i in range(40)]
    kept = {r["doc_id"]: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [kept[i]["kept"] for i in (0, 4, 5, 39, 90, 129)] == [False, False, True, True, True, True]
    assert kept[5]["n_common_words"] == 11


def test_pipeline_cuts_common_lines(spark):
    """Whole rows of the quality stage against a plain version of the rule."""
    menu, rows = "home about contact  login\timprint privacy terms cookies jobs press help", []
    for i in range(60):
        host, line = ("h", "g", None)[i % 3], (menu, menu.upper())[i % 2]
        rows.append((i, f"{prose(30, 300 + i)}\n\n{line}\n{prose(30, 400 + i)}\n" if i % 10 else menu, "en", host, 7))
    rows += [(100 + i, f" {menu}\r\n{prose(40, 500 + i)}", "en", "h", 7) for i in range(25)]
    rows += [(None, f"{menu}\n{prose(20, 600)}", "en", "h", 7), (None, prose(20, 601), "en", None, 7), (3, prose(20, 602), "en", "h", 7)]
    # the same id and text on two hosts: the line is common on one of them
    rows += [(200, f"{menu}\n{prose(20, 603)}", "en", host, 7) for host in ("h", "g")] + [rows[-1]]
    texts, want = {(r[3], r[1]) for r in rows}, []
    norm = lambda line: line.encode().lower().split()
    seen = collections.Counter((h, line) for h, t in texts for line in {tuple(norm(x)) for x in t.split("\n")} if line)
    for i, t, lang, h, n in rows:
        common = lambda x: 20 < seen[h, tuple(norm(x))]  # noqa: B023, E731
        left = "\n".join(x for x in t.split("\n") if not common(x))
        if len(left.split()) >= max(10, 0.3 * len(t.split())):
            want.append((i, left, lang, h, n if left == t else len(left)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.keep_quality(spark, table, SF_SMALL).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert 35 < sum(r["n_chars"] != 7 for r in got) < len(got) < len(rows)


def test_pipeline_cuts_lines_of_large_hosts(spark):
    """A line in 25 documents is common on a host of 25 and on one of 1000; in 20 documents it is not."""
    line, rare, rows = "read more about this and all our other news here", "a line of few documents only", []
    for host, n in (("small", 25), ("large", 1000)):
        for i in range(n):
            top = [*([line] if i < 25 else []), *([rare] if i < 20 else [])]
            rows.append((len(rows), "\n".join([*top, prose(30, 2000 + len(rows))]), "en", host, 7))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"].split("\n") for r in corpus_pipeline.keep_quality(spark, table, SF_SMALL).collect()}
    assert len(got) == len(rows) and not any(line in x for x in got.values())
    assert sum(rare in x for x in got.values()) == 40


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((12, 20))
    x = np.vstack([rng.standard_normal((150, 20)), *(b + 0.22 * rng.standard_normal((15, 20)) for b in base)]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, x[3].tolist()), (901, (2 * x[3]).tolist())]
    bad = [(1000, None), (1001, []), (1002, [0.0] * 20), (1003, [None, *[1.0] * 19]), (1004, [float("nan")] * 20), (1005, [float("inf")] * 20)]
    rows_bad = bad + [(1006, [1.0, 2.0]), (1007, [2.0, 4.0])]
    df = spark.createDataFrame(rows + rows_bad, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embed_dedup.near_vectors(df).collect()}
    v = np.array([r[1] for r in rows], np.float32).astype(float)
    n = np.linalg.norm(v, axis=1)
    linked = v @ v.T / np.outer(n, n) >= 0.9
    ids, label = [r[0] for r in rows], np.arange(len(rows))
    for _ in range(50):
        label = np.array([label[row].min() for row in linked])
    for k, i in enumerate(ids):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (linked[k].sum() - 1, ids[label[k]], ids[label[k]] == i)
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i, _ in bad)
    assert got[1007]["component_id"] == 1006 and (linked.sum() - len(rows)) // 2 > 100
    assert embed_dedup.near_vectors(df.where("vec_id in (1000, 1002)")).count() == 2


def test_near_vectors_with_split_cells(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "TILE", 7)
    test_near_vectors_equal_brute_force(spark)


def test_near_vectors_are_not_shuffled_to_their_partners(spark, monkeypatch):
    """With blocks of 16, copies for every block that a vector is compared with would outgrow the table."""
    plans = []

    def recorded(df, checkpointed=embed_dedup.checkpointed):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return checkpointed(df)

    monkeypatch.setattr(embed_dedup, "TILE", 16)
    monkeypatch.setattr(embed_dedup, "checkpointed", recorded)
    x = np.random.default_rng(8).standard_normal((300, 6)) + 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, [1.0, 0.5])]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        v = x.astype(np.float32).astype(float) if kind == "float" else x
        linked = v @ v.T / np.outer(*2 * [np.linalg.norm(v, axis=1)]) >= 0.9
        got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_vectors(df).collect()}
        assert [got[i] for i in range(301)] == [*(linked.sum(axis=1) - 1), 0]
    of_links = [plan for names, plan in plans if names == ["a", "b", "n"]]
    assert len(of_links) == 2 and not any("Exchange" in plan for plan in of_links)


def test_chat_round_trip(spark):
    turns = [
        (1, 0, "user", "a"), (1, 1, "user", "\\l<next></turn>\n### x:\n"), (1, 2, "assistant", None), (1, 3, "assistant", "# é\\b"),
        (1, None, "a:\n#b", ""), (2, 0, None, "t"), (None, 0, "assistant", "n"), (2, 0, None, "t"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df)
    out = out.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    got = {r["conv_id"]: r for r in out.collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("a:\n#b", ""), ("user", "a"), ("user", turns[1][3]), ("assistant", ""), ("assistant", "# é\\b")]
    assert got[1]["loss"] == "# é\\b" and got[None]["loss"] == "n" and len(got[2]["turns"]) == 2
    assert got[1]["formatted"].count("### assistant:") == 1
    assert chat.format_chats(df.limit(0)).count() == 0


def test_mixing(docs, empty):
    got = mixing.mix(docs, mixing.cycled_weights(docs, [3, 1, 2])).collect()
    assert len(got) == docs.count() and got and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by = collections.defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    total = sum(r["size"] for r in got)
    assert abs(sum(v[0]["target"] for v in by.values()) - 1.5 * total) < 1e-6
    for v in by.values():
        assert abs(sum(r["taken"] for r in v) - v[0]["target"]) <= max(r["size"] for r in v)
    again = mixing.mix(docs, mixing.cycled_weights(docs, [3, 1, 2])).collect()
    assert collections.Counter(got) == collections.Counter(again)
    assert mixing.mix(empty, mixing.cycled_weights(empty, [3, 1, 2])).count() == 0


def test_repeated_rows_follow_the_mix(spark):
    """Null and repeated ids in two sources with different targets, equal rows, and columns named as the helpers."""
    rows = [(None, prose(10, 500 + i % 150), "a", i) for i in range(200)]
    rows += [(None, prose(10, 500 + i % 150), "b", i) for i in range(120)] + [(1, prose(10, 9), "a", i) for i in range(30)]
    rows += [(i, prose(10, 700 + i), None, i) for i in range(10)] + [(2, None, "b", 0), (2, "", "b", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_times int")
    frame = frame.withColumns({"mixed_times": F.lit(1), "mix_copy": F.lit(2), "own_digest": F.lit("x")})
    mixed = mixing.mix(frame, mixing.cycled_weights(frame, [3, 1, 2]))
    got = mixing.repeated(frame, mixed)
    assert got.columns == frame.columns
    taken = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    words = got.groupBy("source").agg(F.sum(mixing.words_of("text")).alias("n"))
    assert {r["source"]: r["n"] for r in words.collect()} == taken
    target = {r["source"]: r["target"] for r in mixed.select("source", "target").distinct().collect()}
    assert len(set(target.values())) == 3 and all(abs(taken[s] - t) <= 10 for s, t in target.items())
    count = lambda df, *c: {tuple(r[:-1]): r[-1] for r in df.groupBy(*c).count().collect()}
    whole = count(frame, "doc_id", "text", "source", "mix_times")
    assert all(n <= 2 * whole[k] for k, n in count(got, "doc_id", "text", "source", "mix_times").items())


def test_common_lines_of_a_large_host_are_cut(spark):
    """A line in 30 of 400 documents of a host is common, whatever share that is; clashing names do no harm."""
    line = "All rights reserved by the owners of this page"
    rows = [(i, prose(40, 2000 + i) + (f"\n{line}" if i < 30 else ""), "big", 1) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, quality_lines int").withColumn("own_hash", F.lit(1))
    found = quality.quality(frame)
    assert found.where("n_common_words > 0").count() == 30 and found.where("kept").count() == 400
    left = quality.without_common_lines(frame, found.where("kept"))
    assert left.columns == [*frame.columns, "cut"] and left.where("cut IS NOT NULL").count() == 30
    assert left.where(F.col("cut").contains("rights reserved")).count() == 0


def test_water_fill_is_the_fixed_point(spark):
    rows = [("a", 3, 10), ("b", 1, 1000), ("c", 2, 100), (None, 3, 50), ("z", 1, 0)]
    plan = mixing.water_fill(spark.createDataFrame(rows, "source string, weight int, source_size long"), 1.5, 2.0).collect()
    target = {r["source"]: r["target"] for r in plan}
    assert target == {"a": 20, "c": 200, None: 100, "z": 0, "b": 1.5 * 1160 - 320}


def test_chunks_cut_passages_and_spare_the_rest(docs, empty):
    rows = raws(docs)
    got = collections.defaultdict(list)
    for r in chunk_dedup.dedup_chunks(docs).collect():
        got[(r["doc_id"], r["n_bytes"])].append(r)
    for i, raw in rows:
        r = got[(i, len(raw))][0]
        cuts = [0, *(x for s in r["spans"] for x in (s["start"], s["start"] + s["length"])), len(raw)]
        assert b"".join(raw[a:z] for a, z in zip(cuts[::2], cuts[1::2])).decode() == r["kept"]
    by = {i: got[(i, len(raw))][0] for i, raw in rows if i is not None}
    assert [by[i]["n_removed"] for i in range(8, 18)] == [0] * 10 and by[18]["kept"] == ""
    assert by[20]["n_removed"] == 0 and min(by[i]["n_removed"] for i in range(21, 26)) > 0.6 * len(PASSAGE.encode())
    assert chunk_dedup.dedup_chunks(empty).count() == 0


def plain_ends(raw):
    """Chunk ends as stated: a byte at a time, the hash of the last 16 bytes in 16 bits, its upper bits zero."""
    gear, ends, last = chunk_dedup._gear_table().tolist(), [], 0
    inside = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
    for i in range(1, len(raw) + 1):
        h = sum(gear[raw[i - 1 - k]] << k for k in range(min(16, i))) & 0xFFFF
        marked = h >> (16 - chunk_dedup.CUT_BITS) == 0 and i - last >= chunk_dedup.LEAST
        if i == len(raw) or (not inside(i) and (marked or i - last >= chunk_dedup.MOST)):
            ends.append(i)
            last = i
    return ends


@pytest.mark.parametrize("min_run", [100, 1])
def test_chunks_equal_brute_force(docs, min_run):
    want, seen = [], set()
    texts = {raw: plain_ends(raw) for _, raw in raws(docs)}
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("h")).collect()
    done = {}
    for i, text, h in sorted(((r["doc_id"], r["text"], r["h"]) for r in hashed), key=order):
        raw = (text or "").encode()
        if (i, raw) not in done:  # rows that repeat an id and a text are one document
            kept, run, spans = bytearray(), None, []
            for a, z in zip([0, *texts[raw]], [*texts[raw], None]):
                if z is not None and raw[a:z] in seen:
                    run = a if run is None else run
                    continue
                if run is not None and a - run >= min_run:
                    spans.append((run, a - run))
                elif run is not None:
                    kept += raw[run:a]
                run = None
                if z is not None:
                    seen.add(raw[a:z])
                    kept += raw[a:z]
            done[(i, raw)] = (bytes(kept).decode(errors="replace"), len(raw), len(texts[raw]), len(raw) - len(kept), spans)
        want.append((repr(i), h, *done[(i, raw)]))
    got = [
        (repr(r["doc_id"]), r["text_hash"], r["kept"], r["n_bytes"], r["n_chunks"], r["n_removed"], [tuple(s) for s in r["spans"]])
        for r in chunk_dedup.dedup_chunks(docs, min_run=min_run).collect()
    ]
    assert sorted(got) == sorted(want) and any(r[5] for r in got)


def test_texts_without_ids_stay_apart(spark):
    """Very many texts under one id, null: each has a key of its own."""
    rows = spark.range(300_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    assert keyed(rows).select("id", "th").distinct().count() == 300_000  # 32 bits would lose some ten


def test_chunk_ends_resist_insertions():
    gear, raw = chunk_dedup._gear_table(), prose(900, 3).encode()
    ends = set(chunk_dedup.boundaries(raw, gear))
    moved = {e if e <= 1000 else e - 5 for e in chunk_dedup.boundaries(raw[:1000] + b"XXXXX" + raw[1000:], gear)}
    assert len(ends - moved) <= 12
    flat = chunk_dedup.boundaries(b"\xc3\xa9" * 3000, gear)
    assert flat[-1] == 6000 and all(e % 2 == 0 for e in flat)


def test_simhash_equals_brute_force(docs, empty):
    rows, want = raws(docs), {}
    for i, raw in rows:
        words = raw.lower().split()
        shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want[key(i, raw)] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((-1 if r[0] is None else r[0], int(r["fingerprint"], 16)) for r in got) == sorted((k[0], v) for k, v in ((key(*r), want[key(*r)]) for r in rows))
    assert next(r for r in got if r["doc_id"] == 18)["component_id"] == 8
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 4, 7])
def test_simhash_links_equal_brute_force(spark, bits):
    rng = np.random.default_rng(bits)
    x = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [v ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for v in x for k in range(bits + 3)]
    x = np.unique(np.concatenate([x, np.array(near, np.uint64)])).view(np.int64)
    got = simhash.links(spark.createDataFrame([(int(v),) for v in x], "fp long"), bits).collect()
    close = np.bitwise_count(x.view(np.uint64)[:, None] ^ x.view(np.uint64)) <= bits
    assert len(got) == len(set(got)) == (close.sum() - len(x)) // 2


def test_simhash_links_never_broadcast_the_index(spark):
    """Spark sizes the 64 variants of a fingerprint as one row, and would send them all through the driver."""
    found = simhash.links(spark.createDataFrame([(v,) for v in (0, 1, 255)], "fp long"))
    assert [tuple(r) for r in found.collect()] == [(0, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (500, 500)] + [(1000, i) for i in range(1001, 1100)]
    got = dict(components(spark.createDataFrame(edges, "src long, dst long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 200, 300), 100), **dict.fromkeys(range(1000, 1100), 1000)}


def test_lm_learns_both_sides(spark, docs, empty):
    rng = np.random.default_rng(8)
    sides = [("red", "apple"), ("blue", "sky"), ("green", "leaf")]
    text = lambda: " ".join(f"{a} {x} {b}" for a, b in (sides[i] for i in rng.integers(0, 3, 60)) for x in ["is"])
    settings = lm_score.Settings(classes=6, buckets=4, masked=0.5, rounds=2, batch=64, step=0.1)
    table = spark.createDataFrame([(i, text()) for i in range(400)], "doc_id long, text string")
    words = lm_score.vocabulary(table, settings)
    flat = lm_score.train(table, words, settings)
    held = [text() for _ in range(5)]
    shuffled = [" ".join(rng.permutation(t.split())) for t in held]
    new = spark.createDataFrame(list(enumerate(held + shuffled)), "doc_id long, text string")
    mean = {r["doc_id"]: r["mean_log_likelihood"] for r in lm_score.score(new, words, flat, settings).collect()}
    assert min(mean[i] for i in range(5)) > -1.2 > -1.6 > max(mean[i] for i in range(5, 10))
    counts, _ = lm_score.Words()(pa.array([b"A b", b"", b" \n", b"c\x0bd E"], pa.binary()))
    assert counts.tolist() == [2, 0, 0, 3]
    got = lm_score.lm_scores(docs, settings).collect()
    assert len(got) == docs.count() and all((r["n_words"] == 0) == (r["mean_log_likelihood"] is None) for r in got)
    assert lm_score.lm_scores(empty, settings).count() == 0


def test_lm_scores_every_word_by_its_own_count(spark, docs):
    settings = lm_score.Settings(classes=4, buckets=3)
    counts = lm_score.word_counts(docs)
    words = lm_score.vocabulary(docs, settings, counts=counts)
    flat = lm_score.train(docs, words, settings)
    texts = [*(r["text"] for r in docs.select("text").collect()), "the zzzz yyyy of zzzz", prose(30, 9) + " qqqq"]
    new = spark.createDataFrame([*enumerate(texts), (0, texts[9]), (None, texts[9])], "doc_id long, text string")
    got = lm_score.score(new, words, flat, settings, counts=counts).collect()
    # the same in plain Python: the network's log-probability of the id, and the word's share of its bucket
    hashed = lm_score.Words()
    seen = collections.Counter(w for _, raw in raws(docs) for w in raw.lower().split())
    names = {w: int(hashed(pa.array([w], pa.binary()))[1].view(np.int64)[0]) for w in {*seen, *(w for t in texts for w in (t or "").encode().lower().split())}}
    bucket = {w: (names[w] % 2**64 >> 20) % 3 for w in names if names[w] not in words}
    total = collections.Counter()
    for w in bucket:
        total[bucket[w]] += seen[w]
    network, want = lm_score.Network(settings, flat), []
    for i, t in [*enumerate(texts), (0, texts[9]), (None, texts[9])]:
        line = (t or "").encode().lower().split()
        ids = np.array([words.index(names[w]) if w not in bucket else 13 + bucket[w] for w in line], np.int32)
        x = float(network.log_probabilities(ids).sum(dtype=float)) + sum(np.log((seen[w] or 0.5) / (total[bucket[w]] + 0.5)) for w in line if w in bucket)
        want.append((-1 if i is None else i, len(line), x))
    got = sorted((-1 if r[0] is None else r[0], r["n_words"], r["log_likelihood"]) for r in got)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-3 * (1 + a[1])
    # a seen word costs less than a misspelt one that shares its bucket
    word = next(w.decode() for w in bucket if seen[w] > 2)
    shares = lambda w: int(hashed(pa.array([w.encode()], pa.binary()))[1][0]) // 2**20 % 3 == bucket[word.encode()]
    pair = word, next(w for w in (f"{word}x{k}" for k in range(99)) if shares(w))
    two = spark.createDataFrame([(i, f"the {w} of") for i, w in enumerate(pair)], "doc_id long, text string")
    cost = {r["doc_id"]: r["log_likelihood"] for r in lm_score.score(two, words, flat, settings, counts=counts).collect()}
    assert cost[0] > cost[1] + 1


def test_lm_scores_do_not_depend_on_the_layout(spark, docs):
    settings = lm_score.Settings(classes=6, buckets=4, batch=64, shard=1000, known=40)
    counts = lm_score.word_counts(docs)
    words = lm_score.vocabulary(docs, settings, counts=counts)
    key = lambda rows: sorted((repr(r[0]), r["n_words"], r["log_likelihood"]) for r in rows.collect())
    found = []
    for n in (1, 8):
        laid = docs.repartition(n, F.rand(n))
        flat = lm_score.train(laid, words, settings)
        found.append((flat, key(lm_score.score(laid, words, flat, settings, counts=counts))))
    assert np.array_equal(found[0][0], found[1][0]) and found[0][0].std() > 0
    for a, b in zip(found[0][1], found[1][1], strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) <= 1e-4 * (1 + abs(a[2]))
    # looked up in the task or joined, a word costs the same
    joined = key(lm_score.score(docs, words, found[0][0], lm_score.Settings(classes=6, buckets=4, known=0), counts=counts))
    for a, b in zip(found[0][1], joined, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) <= 1e-4 * (1 + abs(a[2]))


def test_lm_shards_hold_every_word_and_split_repeats(spark):
    text = "one two three four"
    rows = [(i, text) for i in range(50)] + [(7, text)] * 400 + [(None, text)] * 400 + [(1, None), (2, " "), (3, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    settings = lm_score.Settings(classes=4, buckets=3, shard=340)
    words = lm_score.vocabulary(table, settings)
    sizes = collections.Counter()
    for r in lm_score.shards(table, words, settings, 3400).collect():
        ids = np.frombuffer(r["ids"], settings.id_type)
        assert len(ids) == 4 and set(ids) <= set(range(16))
        sizes[r["shard"]] += len(ids)
    assert sum(sizes.values()) == 3400 and len(sizes) == 10 and max(sizes.values()) < 600


def test_lm_frequent_words_are_bounded(spark):
    counts = spark.createDataFrame([(i, 1000 if i < 5 else 10 if i < 20 else 1) for i in range(100)], "word long, n long")
    for most, size in ((100, 100), (99, 20), (20, 20), (19, 5), (4, 0), (0, 0)):
        hashes, n = lm_score.frequent(counts, most)
        assert hashes.tolist() == list(range(size)) and len(n) == size


def test_lm_trains_on_every_position():
    settings = lm_score.Settings()
    drawn = [lm_score._drawn(b"x y z", 5000, k, settings) for k in range(settings.rounds)]
    assert sorted(np.concatenate(drawn).tolist()) == list(range(5000)) and min(map(len, drawn)) > 2000


def test_pipeline_stages(spark, docs, empty):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for table in (docs, empty):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, "pipeline-test")
            stage(spark, now, SF_SMALL).write.parquet(path)
            before, now = now, spark.read.parquet(path)
            if name != names[-1]:
                assert now.columns == corpus_pipeline.COLUMNS
            if table is docs and name == "SimHash near-dedup":
                kept = simhash.near_duplicates(before).where("kept").select("doc_id", "text_hash").distinct().count()
                assert now.count() == kept < before.count()
        assert (now.count() > 0) == (table is docs)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck_oracle, name):
    from conftest import SF_ORACLE

    ok, said = compare(QUERIES[name](spark, SF_ORACLE), duck_oracle, ORACLE_SQL[name])
    assert ok, said


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert rows
    if name == "op2_packing":
        tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        text = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id = 1").first()["text"]
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for r in (r for r in rows if r["doc_id"] == 1):
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    json.dumps([str(r) for r in rows[:3]])
