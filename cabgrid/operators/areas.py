"""Profitable areas per time window.

Observed rules of the original, per 15 minute window and cell:

* drop-offs: trips whose drop-off falls in the window, by end cell;
* pickups: trips whose pickup falls in the *next* window, by start cell
  (the original joins drop-off window end to pickup window start);
* empty cabs = drop-offs - pickups (missing pickups count 0), kept when > 0;
* profit = median (an element, not interpolated) of fare + tip over trips of at most 900 s
  that ended in the window, by *start* cell;
* profitability = profit / empty cabs, on cells that have both.

The single-purpose operators (``dropoff_counts``, ``pickup_counts``,
``area_profit``) are plain aggregates. ``empty_cabs`` and ``profitability``
fuse them: each trip emits up to three keyed records (``inline`` of an array
of structs, one scan) that are counted by (window, cell, amount); a running
sum over the amounts of a cell gives its exact median, and the same aggregate
adds up the other counts. The two joins of the original disappear, and the
trip table is scanned once instead of three times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.functions.grid import cell_id, sql
from cabgrid.functions.timewin import epoch_micros, from_epoch_micros, micros, pane_windows, window_end, window_start
from cabgrid.operators.cells import END_AXES, START_AXES, in_grid_trips
from cabgrid.operators.medians import median_of_counts

AREA_WINDOW = "15 minutes"
# How far back the intended empty-taxi rule looks for a taxi's last drop-off.
EMPTY_HORIZON = "30 minutes"
# Horizons in a block of time: one task holds the events of one taxi and block.
BLOCK_HORIZONS = 8
SHORT_TRIP_SECS = 900

_KEY = ["window", "east", "south"]


def _cell() -> Column:
    return cell_id("east", "south").alias("cell")


# Empty cabs of the observed rule, over the columns of ``area_stats``.
_EMPTY = "(dropoff_count - pickup_count)"
_CELL_SQL = f"{sql.cell_id('east', 'south')} AS cell"


def revenue() -> Column:
    """Fare plus tip of a trip."""
    return F.col("fare_amount") + F.col("tip_amount")


def short_trips(trips: DataFrame, max_secs: int = SHORT_TRIP_SECS) -> DataFrame:
    """Trips of at most ``max_secs`` seconds, compared as integers."""
    return trips.where(F.col("trip_time_in_secs") <= F.lit(max_secs))


def trip_revenue(trips: DataFrame) -> DataFrame:
    return trips.withColumn("total_profit", revenue())


def _counts(t: DataFrame, win: Column, axes, name: str) -> DataFrame:
    e, s = axes
    return (
        t.select(win.alias("window"), F.col(e).alias("east"), F.col(s).alias("south"))
        .groupBy(*_KEY)
        .agg(F.count(F.lit(1)).alias(name))
        .select("window", _cell(), name)
    )


def dropoff_counts(trips: DataFrame, length: str = AREA_WINDOW, semantics: str = "observed") -> DataFrame:
    """Drop-offs per (window end, end cell): ``window, cell, dropoff_count``."""
    return _counts(in_grid_trips(trips, semantics), window_end("dropoff_datetime", length), END_AXES, "dropoff_count")


def pickup_counts(trips: DataFrame, length: str = AREA_WINDOW, semantics: str = "observed") -> DataFrame:
    """Pickups per (window start, start cell): ``window, cell, pickup_count``."""
    return _counts(
        in_grid_trips(trips, semantics), window_start("pickup_datetime", length), START_AXES, "pickup_count"
    )


def area_profit(
    trips: DataFrame,
    length: str = AREA_WINDOW,
    max_secs: int | None = SHORT_TRIP_SECS,
    semantics: str = "observed",
    slide: str | None = None,
) -> DataFrame:
    """``window, cell, profit``: median fare + tip of short trips by start cell.

    With ``slide``, windows of ``length`` end every ``slide`` (sliding).
    """
    return _area_profit(trips, length, max_secs, semantics, slide).select("window", _cell(), "profit")


def _area_profit(
    trips: DataFrame, length: str, max_secs: int | None, semantics: str, slide: str | None
) -> DataFrame:
    """``area_profit`` by axes: ``window, east, south, profit``.

    Sliding windows that are whole numbers of slides share the counts of
    panes of one slide, which are copied into the windows that hold them.
    """
    t = in_grid_trips(trips, semantics)
    if max_secs is not None:
        t = short_trips(t, max_secs)
    e, s = START_AXES
    panes = slide is not None and micros(length) % micros(slide) == 0
    counts = (
        t.select(
            window_end("dropoff_datetime", slide if panes else length, slide).alias("window"),
            F.col(e).alias("east"),
            F.col(s).alias("south"),
            revenue().alias("revenue"),
        )
        .groupBy(*_KEY, "revenue")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if panes and length != slide:
        counts = counts.withColumn("window", F.explode(pane_windows("window", length, slide)))
    return median_of_counts(counts, _KEY, "revenue", "n", name="profit")


_DROP, _PICK, _PROFIT = 0, 1, 2


def _record(time: str, axes, kind: int, value: str) -> str:
    e, s = axes
    return (
        f"named_struct('time', {time}, 'east', {e}, 'south', {s}, "
        f"'kind', {kind}, 'revenue', CAST({value} AS DOUBLE))"
    )


def _sliding(records: DataFrame, length: str, slide: str) -> DataFrame:
    """A row per window that counts a record: drop-offs before its end, pickups from its start on.

    ``records`` are counted by panes of one slide already, where windows are
    whole numbers of slides (``window``: a pane's end, or its start for pickups).
    """
    reach = F.timestamp_add("MICROSECOND", F.lit(micros(slide) - micros(length)), "window")
    ahead = pane_windows("window", length, slide)
    behind = F.sequence(reach, F.col("window"), F.expr(f"INTERVAL {micros(slide)} MICROSECONDS"))
    return records.withColumn("window", F.explode(F.when(F.col("kind") == _PICK, behind).otherwise(ahead)))


def area_stats(
    trips: DataFrame,
    length: str = AREA_WINDOW,
    max_secs: int | None = SHORT_TRIP_SECS,
    with_profit: bool = True,
    semantics: str = "observed",
    slide: str | None = None,
) -> DataFrame:
    """Drop-offs, next-window pickups and profit per (window, cell), from one scan.

    Output: ``window, east, south, dropoff_count, pickup_count`` and, with
    profit, ``n_profit`` (trips behind the median) and ``profit``. A trip
    counts on each side that has a time.

    With ``slide``, windows of ``length`` start every ``slide``: a window
    counts drop-offs in the ``length`` before its end T and pickups in the
    ``length`` from T on. Where windows are whole numbers of slides, records
    are counted once by panes of one slide, and the counts are copied into
    their windows. Otherwise no window starts where another one ends, so no
    pickup window meets a drop-off window, as in the original's join.
    """
    drop = _record("dropoff_datetime", END_AXES, _DROP, "NULL")
    pick = _record("pickup_datetime", START_AXES, _PICK, "NULL")
    recs = f"array({drop}, {pick})"
    if with_profit:
        prof = _record("dropoff_datetime", START_AXES, _PROFIT, "fare_amount + tip_amount")
        short = "TRUE" if max_secs is None else f"trip_time_in_secs <= {int(max_secs)}"
        recs = f"CASE WHEN {short} THEN array({drop}, {pick}, {prof}) ELSE {recs} END"
    kinds = {"dropoff_count": _DROP, "pickup_count": _PICK} | ({"n_profit": _PROFIT} if with_profit else {})
    counts = [F.expr(f"count_if(kind = {kind})").alias(name) for name, kind in kinds.items()]
    # Each record has its own time, so a trip without a pickup time still counts as a drop-off.
    panes = slide is not None and micros(length) % micros(slide) == 0
    records = in_grid_trips(trips, semantics).selectExpr(f"inline({recs})")
    records = records.withColumn("_win", F.window("time", slide if panes else length, slide))
    window = F.when(F.col("kind") == _PICK, F.col("_win.start")).otherwise(F.col("_win.end"))
    records = records.withColumn("window", window)
    sums = [F.sum(name).alias(name) for name in kinds]
    if panes and length != slide:
        by_pane = records.groupBy(*_KEY, "kind", "revenue").agg(F.count(F.lit(1)).alias("n"))
        records = _sliding(by_pane, length, slide)
        counts = [F.expr(f"sum(if(kind = {kind}, n, 0))").alias(name) for name, kind in kinds.items()]
    if not with_profit:
        return records.groupBy(*_KEY).agg(*counts)
    by_amount = records.groupBy(*_KEY, "revenue").agg(*counts)
    return median_of_counts(by_amount, _KEY, "revenue", "n_profit", *sums, name="profit")


def empty_cabs(
    trips: DataFrame, length: str = AREA_WINDOW, semantics: str = "observed", slide: str | None = None
) -> DataFrame:
    """``window, cell, empty_cabs`` where drop-offs exceed next-window pickups; ``slide`` as in ``area_stats``."""
    stats = area_stats(trips, length, with_profit=False, semantics=semantics, slide=slide)
    return stats.where(f"{_EMPTY} > 0").selectExpr("window", _CELL_SQL, f"{_EMPTY} AS empty_cabs")


def empty_taxis(
    trips: DataFrame, length: str = AREA_WINDOW, horizon: str = EMPTY_HORIZON, semantics: str = "intended"
) -> DataFrame:
    """Intended empty-taxi rule (D3): ``window, cell, empty_cabs``."""
    return _empty_taxis(trips, length, horizon, semantics).select("window", _cell(), "empty_cabs")


def _empty_taxis(trips: DataFrame, length: str, horizon: str, semantics: str) -> DataFrame:
    """``empty_taxis`` by axes: ``window, east, south, empty_cabs``.

    At every window end T (a multiple of ``length``, the evaluation step), a
    taxi is empty in the cell of its latest drop-off in [T - ``horizon``, T) when it has no pickup
    after that drop-off and before T.

    So a drop-off counts from its time until the taxi's next event of either
    kind, for ``horizon`` at most. The next event comes from one window
    function per taxi and block of ``BLOCK_HORIZONS`` horizons; an event is
    also copied to the block before if that one's drop-offs may need it, so at
    most two copies of an event are shuffled whatever the step, and a
    medallion shared by a third of all rows is split by time. The interval is
    expanded straight into an aggregate by (window, cell) that combines
    map-side.
    """
    h, step = micros(horizon), micros(length)
    size = BLOCK_HORIZONS * h
    e, s = END_AXES
    # At equal times pickups come first: only a later one ends a drop-off's interval.
    events = (
        f"array(named_struct('time', dropoff_datetime, 'is_drop', TRUE, 'east', {e}, 'south', {s}), "
        "named_struct('time', pickup_datetime, 'is_drop', FALSE, "
        "'east', CAST(NULL AS BIGINT), 'south', CAST(NULL AS BIGINT)))"
    )
    at, block = F.col("at"), F.floor(F.col("at") / F.lit(size))
    blocks = F.when(F.pmod(at, F.lit(size)) < h, F.array(block, block - 1)).otherwise(F.array(block))
    order = Window.partitionBy("medallion", "block").orderBy("at", "is_drop", "east", "south")
    timed = (
        in_grid_trips(trips, semantics)
        .selectExpr("medallion", f"inline({events})")
        .where("time IS NOT NULL")
        .select("medallion", epoch_micros("time").alias("at"), "is_drop", "east", "south")
        .withColumn("block", F.explode(blocks))
        .withColumn("next", F.lead("at").over(order))
        .where(F.col("is_drop") & (F.col("block") == block))
    )
    # Window ends in (at, last], at multiples of the step plus what the horizon has over.
    last = F.least(at + h, F.coalesce("next", at + h))
    down = lambda x: x - F.pmod(x - h % step, F.lit(step))
    first, last = down(at) + step, down(last)
    ends = F.when(first <= last, F.sequence(first, last, F.lit(step)))
    return (
        timed.select(F.explode(ends).alias("us"), "east", "south")
        .select(from_epoch_micros("us").alias("window"), "east", "south")
        .groupBy(*_KEY)
        .agg(F.count(F.lit(1)).alias("empty_cabs"))
    )


def profitability(
    trips: DataFrame,
    length: str = AREA_WINDOW,
    max_secs: int | None = SHORT_TRIP_SECS,
    semantics: str = "observed",
    horizon: str = EMPTY_HORIZON,
    slide: str | None = None,
) -> DataFrame:
    """``window, cell, profitability`` = profit / empty cabs.

    ``observed`` counts empty cabs as drop-offs minus next-window pickups
    (fused single aggregate); ``intended`` uses ``empty_taxis``. With
    ``slide``, both are evaluated every ``slide``: profit over the last
    ``length``, empty cabs as in ``area_stats`` (observed) or empty taxis
    over the last ``horizon`` (intended, D5).
    """
    if semantics == "intended":
        # Both aggregates are partitioned by these keys already: the join shuffles nothing again.
        empty = _empty_taxis(trips, slide or length, horizon, semantics)
        profit = _area_profit(trips, length, max_secs, semantics, slide)
        return empty.join(profit, _KEY).select(
            "window", _cell(), (F.col("profit") / F.col("empty_cabs")).alias("profitability")
        )
    stats = area_stats(trips, length, max_secs, True, semantics, slide)
    return stats.where(f"{_EMPTY} > 0 AND n_profit > 0").selectExpr(
        "window", _CELL_SQL, f"profit / {_EMPTY} AS profitability"
    )


def topk_cells(prof: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most profitable cells per window; ties by cell text."""
    w = Window.partitionBy("window").orderBy(F.desc("profitability"), F.asc("cell"))
    return (
        prof.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("window", "cell", "profitability", "rank")
    )


def profitability_per_window(prof: DataFrame) -> DataFrame:
    """Mean profitability per window, one row each (W4 + A5 as one aggregate)."""
    return prof.groupBy("window").agg(F.avg("profitability").alias("avg_profitability"))
