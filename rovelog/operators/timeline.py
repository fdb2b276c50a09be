"""What did a source look like at the moment of each event?

:func:`enrich` answers that for many sources in one pass, without joining every
event to every row before it.  Sources and events are put on one time axis per key
and running aggregates are read off at the events:

* time is cut into cells (``CELL``), and a task works on one (key, cell), so a hot
  key is spread over all cells of the period;
* what happened before the cell arrives as one row: rows are first combined
  map-side to one row per (key, cell), and a running aggregate over those few rows
  per key gives the state carried into each cell that holds an event;
* only rows that some event can see are sorted.  Copies (same key and time) are
  combined map-side first, so a cell never holds more rows than it has distinct times,
  however large the table is.

Work and output are linear in rows + events.  Every lookback here reduces to a
running maximum or sum: "was X seen in the last hour" is "is the latest X at most an
hour old", and "how many X in the last 3 days" is a sum in which each X counts +1
when it enters and -1 when it leaves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rovelog.functions.timeops import floor_to, seconds
from rovelog.operators.keyed import all_known

CELL = 300  # seconds
# rows of (key, step) that are broadcast to thin out a source, some 60 bytes each; a cell with
# events has STEPS of them at most
BROADCAST_ROWS = 1_000_000
STEPS = 16
# bits of the filter that many steps leave of a source before its shuffle, however many steps there
# are: FILTER_WORDS numbers of 64 to a row, so its broadcast has 16,384 rows (2.9 MB) at most
FILTER_BITS, FILTER_WORDS = 1 << 24, 16

# order of rows that share a time: carried state, rows that count at their own
# time, events, rows that count only later
_CARRIED, _AT, _EVENT, _AFTER = -1, 0, 1, 2


@dataclass(frozen=True)
class Reach:
    """Only rows whose time is in the ``length`` before an event matter.

    ``at`` may be on another clock than the events; ``behind`` gives the least and the
    greatest distance from the events' clock.  A test of the raw time is cheaper than
    converting every row first.
    """

    at: Column
    length: timedelta
    behind: tuple[timedelta, timedelta] = (timedelta(0), timedelta(0))

    @property
    def step(self) -> int:
        """Seconds; about a twelfth of the period, so an event lists a dozen steps."""
        whole = int((self.length + self.behind[1] - self.behind[0]).total_seconds())
        return max(1, -(-whole // (12 * CELL))) * CELL

    @property
    def start(self) -> Column:
        return floor_to(seconds(self.at), self.step)


@dataclass(frozen=True)
class Track:
    """Timed rows of one source and what to remember of them.

    ``latest`` keeps the greatest value per name, ``total`` the sum.  Where ``after``
    holds, a row counts only for strictly later events.  ``reach`` says which rows can
    matter at all; the others are dropped as early as possible.  ``whole`` says that
    the rows have been thinned out already; such a track may also treat null keys as
    one key (``null_keys``, as grouping does) instead of as no key.  ``grouped`` says that
    they come from an aggregate, few to a key: no filter goes before their next shuffle.
    """

    rows: DataFrame
    at: Column
    latest: dict[str, Column] = field(default_factory=dict)
    total: dict[str, Column] = field(default_factory=dict)
    after: Column | None = None
    reach: Reach | None = None
    whole: bool = False
    null_keys: bool = False
    grouped: bool = False


@dataclass(frozen=True)
class Feature:
    """Tracks, and the result columns computed from their state at the event."""

    tracks: Sequence[Track]
    columns: dict[str, Column]


def fit_broadcast(cells: int, rows: int | None = None) -> bool:
    """Whether the steps of that many cells are within the bound for a broadcast."""
    return cells * STEPS <= (BROADCAST_ROWS if rows is None else rows)


def cell_of(ts: Column, width: int = CELL) -> Column:
    return floor_to(seconds(ts), width)


def event_cells(events: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """The different keys and cells that hold events."""
    return events.select(*keys, cell_of(at).alias("_cell")).distinct()


def enrich(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[Feature],
    *,
    at: Column | None = None,
    cells: DataFrame | None = None,
    few: bool | None = None,
) -> DataFrame:
    """``events`` with the columns of all ``features``; one output row per input row.

    ``at`` replaces the event time by another time on the axis of the tracks.
    ``cells`` may be the :func:`event_cells` as written before; left out, they are found
    in the events wherever they are read.  ``few`` says whether these are few enough to be
    broadcast; left out, they are counted.
    """
    keys = list(keys)
    tracks = [track for feature in features for track in feature.tracks]
    at = F.col(ts) if at is None else at

    probes = events.select(
        *keys,
        cell_of(at).alias("_cell"),
        at.alias("_at"),
        F.lit(_EVENT).alias("_side"),
        F.struct(*events.columns).alias("_event"),
    )
    cells = event_cells(events, keys, at) if cells is None else cells

    latest = sorted({name for track in tracks for name in track.latest})
    totals = sorted({name for track in tracks for name in track.total})

    history = any(t.reach is None and not t.whole for t in tracks)
    first = last = None
    if history or few is None and not all(t.whole for t in tracks):
        found = cells.agg(F.count(F.lit(1)), F.min("_cell"), F.max("_cell")).first()
        first, last = found[1], found[2]
        few = fit_broadcast(found[0]) if few is None else few

    before, near = [], []
    for track in tracks:
        rows = _positioned(track, keys)
        by = [*keys, "_cell", "_at", "_side"]
        if track.whole:
            seen = _combined(rows, track, by)
        elif track.reach is not None:
            # few rows are left: combine them once and use them for both
            seen = within_reach(rows, partial(_combined, track=track, by=by), cells, keys, track.reach, few, track.grouped)
        else:
            seen = matching(rows, partial(_combined, track=track, by=by), cells, [*keys, "_cell"], few, track.grouped)
            before.append(_history(rows, track, keys, first, last))
        if track.whole or track.reach is not None:
            before.append(_combined(seen, track, [*keys, "_cell"]))
        near.append(seen)

    earlier = Window.partitionBy(*keys).orderBy("_cell").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        _stack([*before, cells.withColumn("_wanted", F.lit(True))])
        .select(*keys, "_cell", "_wanted", *_running(latest, totals, earlier))
        .where("_wanted")
        .drop("_wanted")
        .withColumn("_side", F.lit(_CARRIED))
    )

    so_far = Window.partitionBy(*keys, "_cell").orderBy(F.col("_at").asc_nulls_first(), "_side")
    seen = (
        _stack([probes, carried, *near])
        .select("_event", *_running(latest, totals, so_far))
        .where(F.col("_event").isNotNull())
        .select("_event.*", *latest, *totals)
    )
    results = {name: c for feature in features for name, c in feature.columns.items()}
    return seen.select(*events.columns, *[c.alias(name) for name, c in results.items()])


def _history(rows: DataFrame, track: Track, keys: list[str], first: int | None, last: int | None) -> DataFrame:
    """One row per key and cell, all that came before the ``first`` cell with an event as one.

    Rows after the ``last`` one are of no use.  So a key's list follows the period of the
    events, not all history.
    """
    if first is not None:
        rows = rows.where(F.col("_cell") <= last).withColumn("_cell", F.greatest("_cell", F.lit(first - CELL)))
    return _combined(rows, track, [*keys, "_cell"])


def _positioned(track: Track, keys: list[str]) -> DataFrame:
    side = F.lit(_AT) if track.after is None else F.when(track.after, _AFTER).otherwise(_AT)
    columns = {"_at": track.at, "_cell": cell_of(track.at), "_side": side, **track.latest, **track.total}
    if track.reach is not None:
        columns["_start"] = track.reach.start
    rows = track.rows.select(*keys, *[c.alias(name) for name, c in columns.items()])
    # a converted time is null where the raw one is, and that is cheaper to ask
    usable = ["_at" if track.reach is None else "_start"]
    if not track.null_keys:
        usable += keys
    return rows.where(all_known(*usable))


def _combined(rows: DataFrame, track: Track, by: list[str]) -> DataFrame:
    """One row per ``by``, combined before the shuffle, however many copies there are.

    Values are in the same order everywhere, or Spark would not see that two uses of
    the combined rows can share one shuffle.
    """
    if "_start" in rows.columns:
        by = [*by, "_start"]
    return rows.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in sorted(track.latest)], *[F.sum(c).alias(c) for c in sorted(track.total)]
    )


def within_reach(
    rows: DataFrame,
    combine: Callable[[DataFrame], DataFrame],
    cells: DataFrame,
    keys: Sequence[str],
    reach: Reach,
    few: bool,
    grouped: bool = False,
) -> DataFrame:
    """Combined rows whose ``_start`` is in reach of an event, give or take a step."""
    step = reach.step
    nearest = int(reach.behind[1].total_seconds())
    farthest = int((reach.behind[0] - reach.length).total_seconds())
    first = floor_to(F.col("_cell") + farthest, step)
    last = floor_to(F.col("_cell") + CELL + nearest, step)
    steps = (
        cells.select(*keys, first.alias("_first"), last.alias("_last"))
        .select(*keys, F.explode(F.sequence("_first", "_last", F.lit(step).cast("bigint"))).alias("_start"))
        .distinct()
    )
    return matching(rows, combine, steps, [*keys, "_start"], few, grouped).drop("_start")


def matching(
    rows: DataFrame,
    combine: Callable[[DataFrame], DataFrame],
    wanted: DataFrame,
    on: list[str],
    few: bool,
    grouped: bool = False,
) -> DataFrame:
    """Combined rows of the ``wanted`` (distinct) keys.

    Few keys are broadcast, many are met by a shuffle.  Either way rows are thinned out
    before they are combined: combining goes by the shuffled columns and more, so it
    needs no further shuffle and sorts only what some event can see.  What is shuffled to
    meet many keys has passed a filter of fixed size first, unless it is ``grouped``.
    """
    if not few and not grouped:
        rows = thinned(rows, wanted, on)
    return combine(rows.join(F.broadcast(wanted) if few else wanted, on, "left_semi"))


def thinned(rows: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` without most of those whose ``on`` is not in ``wanted``, and no fewer than the others.

    Each wanted key sets one of FILTER_BITS bits, by its hash; a row stays if its bit is set.
    The bits are put together by an aggregate and broadcast as rows of FILTER_WORDS numbers of 64, since
    the driver builds the filters of all sources side by side.  Of other rows
    the share stays that is set of the bits; a filter with most bits set is of no use but does no
    harm.  Keys of different types on the two sides would hash differently; then all rows stay.
    """
    if any(rows.schema[c].dataType != wanted.schema[c].dataType for c in on):
        return rows
    bit = F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))
    row = F.floor(bit / (64 * FILTER_WORDS))
    word, at = F.pmod(F.shiftright(bit, 6), F.lit(FILTER_WORDS)).cast("int"), bit.bitwiseAND(63).cast("int")
    set_ = wanted.select(row.alias("_row"), word.alias("_word"), F.expr("1L").alias("_one"), at.alias("_bit_at"))
    word_bits = [F.bit_or(F.when(F.col("_word") == i, F.expr("shiftleft(_one, _bit_at)"))) for i in range(FILTER_WORDS)]
    bits = set_.groupBy("_row").agg(F.array(*[F.coalesce(w, F.expr("0L")) for w in word_bits]).alias("_bits"))
    return rows.join(F.broadcast(bits), (row == F.col("_row")) & (F.getbit(F.get("_bits", word), at) == 1), "left_semi")


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _running(latest: list[str], totals: list[str], window) -> list[Column]:
    return [F.max(c).over(window).alias(c) for c in latest] + [
        F.coalesce(F.sum(c).over(window), F.lit(0)).alias(c) for c in totals
    ]
