"""CSV/text scans and sinks, row positions within files, unions.

Row position within a file: CSV has no row index, and the original pairs
fare and trip rows by position. Spark splits a large file into blocks that
different tasks read; each block is identified by ``_metadata.file_path`` and
``_metadata.file_block_start``. Inside a task, ``monotonically_increasing_id``
numbers rows consecutively, so a row's position is

    rows in earlier blocks of the same file + (its id - first id of its block)

The per-block table has one row per input split (about 200k rows for 100 TB
in 512 MiB splits); adaptive execution broadcasts it by its measured size. No
task ever holds a whole file.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabgrid.session import scratch_path
from cabgrid.sources.schema import TRIP_SCHEMA


# Columns after the drop-off time that spread rows with equal or no drop-off times.
_SPREAD = ("pickup_datetime", "medallion", "hack_license")
# With a row limit, files up to the first size are read whole, and a task takes up to the second of them, where
# opening a file counts as the first.
SMALL_FILE, SMALL_FILES = 1 << 22, 1 << 28


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = TRIP_SCHEMA,
    header: bool = False,
    **options,
) -> DataFrame:
    """Declared-schema CSV scan (headerless by default); globs and folders work."""
    reader = spark.read.option("header", header).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = False,
    order_by: list | None = None,
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    **options,
) -> None:
    """CSV sink.

    ``order_by`` sorts globally (range partitioning): part files read in part
    order give the sorted table, written by many tasks.
    The default mode fails when the folder exists, like the original.
    ``join_parts`` makes one file of the parts.
    """
    out = df.orderBy(*order_by) if order_by else df
    writer = out.write.mode(mode).option("header", header).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def join_parts(spark: SparkSession, folder: str, target: str, copy_at_most: int = 1 << 30) -> str:
    """Makes one file, ``target``, of the part files of a headerless ``folder``, in part order.

    The parts are written by many tasks; a file system that can (HDFS) then
    links their blocks into one file without moving a byte, and the folder
    goes. Others copy the parts one after another, for outputs of at most
    ``copy_at_most`` bytes, checked first: larger ones stay a folder. Fails if
    ``target`` is there.
    """
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(folder).getFileSystem(hadoop)
    if fs.exists(at(target)):
        raise FileExistsError(target)
    parts = sorted((s.getPath().toString(), s.getLen()) for s in fs.listStatus(at(folder)))
    parts = [(p, n) for p, n in parts if p.rsplit("/", 1)[-1].startswith("part-")]
    if fs.hasPathCapability(at(folder), "fs.capability.paths.concat") and any(n for _, n in parts):
        full = [p for p, n in parts if n]
        rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(full) - 1)
        for i, p in enumerate(full[1:]):
            rest[i] = at(p)
        if len(full) > 1:
            fs.concat(at(full[0]), rest)
        fs.rename(at(full[0]), at(target))
        fs.delete(at(folder), True)
        return target
    size = sum(n for _, n in parts)
    if size > copy_at_most:
        raise ValueError(f"{folder} holds {size} bytes; its file system joins no files, and only {copy_at_most} are copied")
    copying = f"{target}._copying"  # the target appears whole or not at all
    out = fs.create(at(copying), True)
    try:
        for p, _ in parts:
            part = fs.open(at(p))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
            finally:
                part.close()
    finally:
        out.close()
    fs.rename(at(copying), at(target))
    return target


def with_file_position(scan: DataFrame, file_col: str = "source_file", pos_col: str = "row_pos") -> DataFrame:
    """Adds the source file and the 0-based row position within it.

    ``scan`` must be a plain file scan: the metadata columns and the row ids
    are taken right at the reader, before any shuffle. Part files of a folder
    that Spark wrote are one file, in the order of their names. The scan is
    written once to the shared folder, and both the rows and the offsets of
    their blocks come from there, so they belong together however later jobs
    split their input. The join with the offsets (a row per input split) is
    left to adaptive execution.
    """
    spark = scan.sparkSession
    base = scan.select(
        "*",
        F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "").alias(file_col),
        F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")).alias("_block"),
        F.monotonically_increasing_id().alias("_rid"),
    )
    path = scratch_path(spark, "positions")
    base.write.parquet(path)
    base = spark.read.schema(base.schema).parquet(path)
    return _placed(base, file_col, pos_col)


def _placed(base: DataFrame, file_col: str, pos_col: str) -> DataFrame:
    """Positions in the whole file from ``_rid``, consecutive within a ``_block`` of the file."""
    blocks = base.groupBy(file_col, "_block").agg(
        F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy(file_col).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        file_col, "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        base.join(offsets, [file_col, "_block"])
        .withColumn(pos_col, F.col("_offset") + F.col("_rid") - F.col("_first"))
        .drop("_block", "_rid", "_first", "_offset")
    )


def first_rows_per_file(
    spark: SparkSession, path: str, n: int, file_col: str = "source_file", pos_col: str = "row_pos", **options
) -> DataFrame:
    """The first ``n`` rows of every CSV file, with file and position as in ``with_file_position``.

    Only these rows are written and used. Files of over ``SMALL_FILE`` bytes
    are a task each, which takes ``n`` rows and ends. A Python worker that is
    already running stops the scan soon after them; for one that has to start,
    Spark was seen to read the file on. Smaller files cost less to read on
    than a task to start: a task takes many of them, each whole, so tasks and
    written files follow the bytes, not the number of files. A session of its
    own holds the settings for either kind. Part files of a folder are one file:
    every part gives up to ``n`` rows, and a later part's rows stay only as
    far as the earlier parts had fewer. (If the settings do not hold, files
    are read to their end, for the same result.)
    """
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(max(1, min(n, 1000))))  # little is read ahead
    scan = read_csv(own, path, schema=None, **options)
    block = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    file = F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "").alias(file_col)
    base = scan.select("*", file, block.alias("_block"))

    def first(batches: Iterator[pa.RecordBatch], stops: bool) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in batches:
            blocks = pc.struct_field(batch.column("_block"), "path"), pc.struct_field(batch.column("_block"), "start")
            at = 0
            while at < batch.num_rows:
                of = tuple(c[at].as_py() for c in blocks)
                same = pc.and_(pc.equal(blocks[0], of[0]), pc.equal(blocks[1], of[1])).slice(at)
                length = pc.index(same, False).as_py()
                length = len(same) if length < 0 else length
                done = seen.get(of, 0)
                keep = batch.slice(at, min(length, n - done))
                rid = pa.array(range(done, done + keep.num_rows), pa.int64())
                if keep.num_rows:
                    yield pa.RecordBatch.from_arrays([*keep.columns, rid], [*batch.schema.names, "_rid"])
                seen[of] = done + keep.num_rows
                at += length
                if stops and seen[of] == n:
                    return

    schema = T.StructType([*base.schema.fields, T.StructField("_rid", T.LongType())])
    folder = scratch_path(spark, "first-rows")
    size = F.col("_metadata.file_size")  # files are chosen by it before any is opened
    # (bytes of a task, cost of opening a file): a file no larger than the cost is never split
    for where, most, cost in ((size <= SMALL_FILE, SMALL_FILES, SMALL_FILE), (size > SMALL_FILE, 1 << 40, 1 << 40)):
        settings = {"spark.sql.files.maxPartitionBytes": str(most), "spark.sql.files.openCostInBytes": str(cost)}
        for key, value in settings.items():
            own.conf.set(key, value)
        alone = most == cost and all(own.conf.get(key) == value for key, value in settings.items())
        rows = base.where(where).mapInArrow(partial(first, stops=alone), schema)
        rows.write.mode("append").parquet(folder)
    return limit_per_file(_placed(spark.read.schema(schema).parquet(folder), file_col, pos_col), n, pos_col)


def limit_per_file(positioned: DataFrame, n: int, pos_col: str = "row_pos") -> DataFrame:
    """The first ``n`` rows of every file (``nrows`` per file of the original)."""
    return positioned.where(F.col(pos_col) < n)


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Concatenation by column name (``UNION ALL``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def strip_blanks(df: DataFrame) -> DataFrame:
    """Removes blanks from column names (fare headers carry leading blanks)."""
    return df.toDF(*[c.replace(" ", "") for c in df.columns])


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Selects the schema's columns in order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_trips_parquet(trips: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Trips as Parquet, partitioned by drop-off date (``dropoff_date=YYYY-MM-DD``).

    The store to keep at scale instead of CSV: a query reads only its
    columns, the coordinate bounding box of the outlier filter reaches the
    reader as pushed filters (row-group statistics), and date filters prune
    whole folders. Range partitioning on drop-off time splits a busy day over
    several tasks, and the local sort keeps row groups tight in time. Equal
    and missing drop-off times are spread by the other columns of a ride.
    """
    t = trips.withColumn("dropoff_date", F.to_date("dropoff_datetime"))
    (
        t.repartitionByRange("dropoff_datetime", *_SPREAD)
        .sortWithinPartitions("dropoff_datetime")
        .write.mode(mode)
        .partitionBy("dropoff_date")
        .parquet(path)
    )


def read_trips(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Trips from headerless CSV (declared schema) or from the Parquet store."""
    if fmt == "csv":
        return read_csv(spark, path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown trip format {fmt!r}")


def write_per_window(df: DataFrame, path: str, window_col: str = "window_end", mode: str = "errorifexists") -> None:
    """Rows of each window side by side, in a folder per day (``<path>/day=<date>/``).

    The distributed form of printing each window's rows in a driver loop. A
    range exchange on the window column deals the windows out by their rows,
    so files follow the data instead of the number of windows; within a file
    rows lie by window, then rank.
    """
    order = [window_col, *[c for c in ("rank",) if c in df.columns]]
    out = df.withColumn("day", F.to_date(window_col)).repartitionByRange(*order).sortWithinPartitions("day", *order)
    out.write.mode(mode).partitionBy("day").option("header", True).csv(path)


def read_per_window(spark: SparkSession, path: str, schema: T.StructType, window=None, window_col: str = "window_end") -> DataFrame:
    """Reads ``write_per_window`` output; with ``window`` (a datetime) that window alone, from its day's folder."""
    layout = T.StructType([*schema.fields, T.StructField("day", T.DateType())])
    df = spark.read.schema(layout).option("header", True).csv(path)
    if window is not None:
        df = df.where((F.col("day") == F.lit(window.date())) & (F.col(window_col) == F.lit(window).cast(schema[window_col].dataType)))
    return df.select(*schema.names)
