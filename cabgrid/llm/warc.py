"""WARC archives: writing captures as records, reading records, assembling transactions.

A capture is a request, a response (or revisit) and a metadata record. The
request and the metadata name the response in ``WARC-Concurrent-To``.
Archives are written by Spark's text writer with the record separator as line
end, so they can lie in any store Spark writes to, one archive per task.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: Payloads under so many bytes are always stored.
MIN_REVISIT_BYTES = 100
#: Bytes of payload in an archive, about; a reader's task holds one archive.
ARCHIVE_BYTES = 32 << 20

RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, concurrent_to string, refers_to string, "
    "payload_digest string, payload_bytes bigint, headers map<string,string>, http_head string, payload binary"
)


def _record(kind: str, record_id: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """Text of a record but for the line end that the writer adds; fields that are null are left out."""
    lines = [
        F.lit(VERSION + CRLF),
        F.concat(F.lit(f"WARC-Type: {kind}{CRLF}WARC-Record-ID: <"), record_id, F.lit(">" + CRLF)),
        *(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in fields),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF)),
        block,
        F.lit(CRLF),
    ]
    return F.concat(*lines)


def _line(col: Column) -> Column:
    """A header value: line breaks would end it."""
    return F.regexp_replace(col, r"[\r\n]+", " ")


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    tasks: int | None = None,
) -> DataFrame:
    """``value``: the text of each record, three per row of ``pages``.

    With ``tasks``, rows are then dealt in turn to so many tasks before their
    records are written out, so that headers are not shuffled; else they stay
    where the one shuffle of the payloads brings them.

    Of rows with equal payloads of at least ``MIN_REVISIT_BYTES`` bytes, the
    one with the smallest id is the response and the others revisit it. A null
    payload is empty, a null url is left out. A record's id holds the row's id
    and half of its payload's digest, so rows that repeat an id with another
    payload are captures of their own. Rows that repeat an id and a payload
    give records of one id, which ``transactions`` reads as one capture; the
    id null is larger than any other. Which ids revisit is found from ids and
    digests alone, in an aggregate that combines map-side and a join on the
    digest, where adaptive execution splits a hot one; payloads are shuffled
    once, by id and digest.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("name"),
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("order"),
        _line(F.col(url_col).cast("string")).alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha2(payload.cast("binary"), 256)).alias("digest"),
    )
    large = F.octet_length("payload") >= MIN_REVISIT_BYTES
    named = rows.where(large).select("digest", "order").distinct()
    first = named.groupBy("digest").agg(F.min("order").alias("first"), F.count(F.lit(1)).alias("ids")).where("ids > 1")
    revisits = named.join(first.drop("ids"), "digest").where(F.col("order") != F.col("first"))
    revisit = F.col("first").isNotNull()
    rows = rows.join(revisits, ["order", "digest"], "left").select(
        "name",
        "url",
        "digest",
        F.octet_length("payload").alias("size"),
        F.when(~revisit, F.col("payload")).alias("payload"),  # a revisit stores none
        F.col("first").cast("string").alias("first"),  # of two ids the smaller one, so not null's
    )
    rows = rows.repartition(tasks) if tasks else rows
    rows = rows.withColumn("digest", F.lower(F.hex("digest")))
    uuid = lambda kind, name: F.concat(F.lit(f"urn:capture:{kind}:"), name, F.lit(":"), F.substring("digest", 1, 32))
    target = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    concurrent = ("WARC-Concurrent-To", F.concat(F.lit("<"), uuid("response", F.col("name")), F.lit(">")))
    refers = ("WARC-Refers-To", F.concat(F.lit("<"), uuid("response", F.col("first")), F.lit(">")))
    profile = ("WARC-Profile", F.lit(REVISIT_PROFILE))
    http = ("Content-Type", F.lit("application/http"))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(CRLF + CRLF),
    )
    path = F.coalesce(F.regexp_extract("url", r"^[a-z]+://[^/]*(/.*)$", 1), F.lit("/"))
    ask = F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(f" HTTP/1.1{CRLF}{CRLF}"))
    note = F.concat(F.lit("fetched: "), F.coalesce("url", F.lit("")), F.lit(CRLF))
    name = F.col("name")
    answer = F.when(
        F.col("first").isNotNull(), _record("revisit", uuid("response", name), [target, digest, refers, profile, http], head)
    ).otherwise(_record("response", uuid("response", name), [target, digest, http], F.concat(head, F.col("payload"))))
    return rows.select(
        F.explode(
            F.array(
                _record("request", uuid("request", name), [target, concurrent, http], ask),
                answer,
                _record(
                    "metadata",
                    uuid("metadata", name),
                    [target, concurrent, ("Content-Type", F.lit("application/warc-fields"))],
                    note,
                ),
            )
        ).alias("value")
    )


def write_archives(
    pages: DataFrame,
    path: str,
    archives: int | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> None:
    """Writes the records of ``pages`` as gzip archives into the folder ``path``.

    With a number of ``archives``, captures are dealt out in turn to so many.
    Without one, a task writes the captures that the shuffle of the payloads
    brought it, and starts another archive after as many as have about
    ``ARCHIVE_BYTES`` of payload by the mean of all, so a reader's task stays
    bounded however large the input is.
    """
    most = 0
    if archives is None:
        payload = F.octet_length(F.col(payload_col).cast("string"))
        rows, size = pages.agg(F.count(F.lit(1)), F.coalesce(F.sum(payload), F.lit(0))).first()
        most = 3 * max(1, rows * ARCHIVE_BYTES // max(size, ARCHIVE_BYTES))
    texts = records(pages, id_col, url_col, payload_col, archives)
    texts.write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def _parsed(raw: bytes) -> Iterator[tuple]:
    """The records of an archive in RECORD_SCHEMA's order, by their Content-Length."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split(CRLF)
        if lines[0] != VERSION:
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        start, n = end + 4, int(fields["Content-Length"])
        block = raw[start : start + n]
        if len(block) != n or raw[start + n : start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"truncated WARC record at byte {at}")
        at = start + n + 4
        kind, head, payload, size = fields["WARC-Type"], None, block, len(block)
        if fields.get("Content-Type") == "application/http":
            top, _, payload = block.partition(b"\r\n\r\n")
            head, size = top.decode(), len(payload)
            if kind == "revisit" and (told := re.search(r"(?im)^content-length: *(\d+)", head)):
                size = int(told[1])
        bare = {k: fields[k].strip("<>") for k in ("WARC-Record-ID", "WARC-Concurrent-To", "WARC-Refers-To") if k in fields}
        digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None
        if kind == "response" and digest != (found := hashlib.sha256(payload).hexdigest()):
            raise ValueError(f"payload digest {digest} of {bare['WARC-Record-ID']} is not {found}")
        yield (
            bare["WARC-Record-ID"], kind, fields.get("WARC-Target-URI"), bare.get("WARC-Concurrent-To"),
            bare.get("WARC-Refers-To"), digest, size, list(fields.items()), head, payload,
        )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder, plain or gzip; a task holds one archive at a time.

    Damaged records fail the job; an empty folder or archive gives no rows.
    """
    types = [
        pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
        pa.map_(pa.string(), pa.string()), pa.string(), pa.binary(),
    ]
    names = [x.split()[0] for x in re.split(r", (?=\w+ )", RECORD_SCHEMA)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                raw = content.as_py()
                raw = zlib.decompress(raw, 47) if raw[:2] == b"\x1f\x8b" else raw
                rows, held = [], 0
                for row in _parsed(raw):
                    rows.append(row)
                    held += len(row[-1])
                    if held >= 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD_SCHEMA)


def transactions(found: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``request`` and ``metadata`` structs.

    ``found`` are records as ``read_records`` gives them; the structs hold its
    columns in ``fields`` (default: all). Requests and
    metadata records join their response or revisit through
    ``concurrent_to``; a capture without one of them has null there, of
    several the one with the smallest record id counts, and records that name
    no response that exists are left out. Responses or revisits that repeat a
    record id are one capture: the one with the smallest type and target,
    null first, counts. (A revisit repeats what is stored elsewhere, so a
    record id that has both is read as its response.)
    """
    keep = F.struct(*(found.columns if fields is None else fields))
    answers = found.where(F.col("record_type").isin("response", "revisit"))
    answers = answers.groupBy(F.col("record_id").alias("capture_id")).agg(
        F.min_by(keep, F.struct("record_type", "target_uri")).alias("response")
    )
    for kind in ("request", "metadata"):
        side = found.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
        side = side.groupBy(F.col("concurrent_to").alias("capture_id")).agg(
            F.min_by(keep, F.struct("record_id", "target_uri")).alias(kind)
        )
        answers = answers.join(side, "capture_id", "left")
    return answers
