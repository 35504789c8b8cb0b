"""Matching over the whole stream, whatever batch a reading arrives in.

Readings may come late and out of order by up to ``delay``.  Each group (a house, or
an area of a house) keeps its readings in state until the watermark has passed them:
then none of an earlier time can follow, and they are released in time order.  What
is released but still waits for its match stays open.  So a group holds the readings
of the last ``delay`` and its open ones, and both leave the state once they are
matched.  Event-time timers release groups that receive nothing any more.

Readings below the watermark are late; Spark leaves them out and counts them in the
progress of the query (``numRowsDroppedByWatermark``).

A *mark* is a row with a time and nothing else.  It says that all readings up to its
time less ``delay`` have arrived, and moves the watermark while houses are silent.

Groups share buckets, by hash: a bucket is what Spark groups by, and its groups are
matched together, in columns.  State and timers are then touched a few times per
bucket and batch, not per reading.  A bucket is worked off by one task per batch;
their number is fixed for the life of a checkpoint.  ``parts`` (a column) spreads the
openings of a hot group over buckets by event id; what closes them goes to every
part.  State lies in RocksDB, as Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roomtrace import schema as S
from roomtrace.functions.expressions import from_micros, micros, presence_is
from roomtrace.operators.splitting import salt_of
from roomtrace.session import ship_package, use_rocksdb

#: Buckets that the groups share, unless the caller says otherwise.
BUCKETS = 1024
#: Readings of a batch in state.
STORED_ROWS = 50_000


def is_mark() -> Column:
    others = ["event_id", "house_id", "property_device", "value_property_device", "area"]
    mark = F.col("event_ts").isNotNull()
    for c in others:
        mark = mark & F.col(c).isNull()
    return mark


class InTimeOrder(StatefulProcessor):
    """Holds readings ``us, opens, label, event_id`` of the groups of a bucket back until the watermark has passed them."""

    #: Columns of the group that are part of the result, and of what ``release`` finds.
    KEYS: tuple[str, ...] = ()
    FOUND: tuple[str, ...] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "readings binary")
        self.open = handle.getListState("open", "readings binary")
        self.columns = [*self.KEYS, "us", "opens", "label", "event_id"]
        self.released: set[tuple] = set()

    def release(self, open_: pd.DataFrame, ready: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        """What the next readings find, and what is open after them; no earlier ones will follow."""
        raise NotImplementedError

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            new = frame.loc[~frame["mark"].astype(bool), self.columns]
            if len(new):
                self.waiting.appendList(_packed(new))
                least = int(new["us"].min())
                first = least if first is None else min(first, least)
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # The first timer of a batch releases all that the others were set for.
        if key in self.released:
            return
        self.released.add(key)
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, before = self._kept(self.waiting), self._kept(self.open)
        is_ready = waiting["us"].to_numpy("int64") <= passed
        found, after = self.release(before, waiting[is_ready], passed)
        if is_ready.any():
            rest = waiting[~is_ready]
            self._keep(self.waiting, rest)
            if len(rest):
                self._wake(int(rest["us"].min()))
        if len(after) != len(before) or is_ready.any():
            self._keep(self.open, after)
        if (when := self.expires(after)) is not None:
            self._wake(when)
        if len(found):
            yield found[[*self.KEYS, *self.FOUND]]

    def expires(self, open_: pd.DataFrame) -> int | None:
        """When open readings should be looked at again though nothing arrives."""
        return None

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 + 1)

    def _kept(self, state) -> pd.DataFrame:
        if not state.exists():
            return pd.DataFrame({c: [] for c in self.columns})
        stored = [pa.ipc.open_stream(r[0]).read_all() for r in state.get()]
        # A column that is null in one batch has no type there.
        return pa.concat_tables(stored, promote_options="default").to_pandas()

    @staticmethod
    def _keep(state, rows: pd.DataFrame) -> None:
        if len(rows):
            state.put(_packed(rows))
        else:
            state.clear()

    def close(self) -> None:
        pass


def _packed(rows: pd.DataFrame) -> list[tuple[bytes]]:
    found = []
    for start in range(0, len(rows), STORED_ROWS):
        batch = pa.RecordBatch.from_pandas(rows.iloc[start : start + STORED_ROWS], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        found.append((sink.getvalue().to_pybytes(),))
    return found


def _together(open_: pd.DataFrame, ready: pd.DataFrame) -> pd.DataFrame:
    """All rows, or those of one frame as they are: an empty frame has no types."""
    frames = [f for f in (open_, ready) if len(f)]
    return pd.concat(frames, ignore_index=True) if frames else ready


def _ranked(values: pd.Series) -> np.ndarray:
    """Numbers in the order of ``values``.  Nulls come first, as in Spark."""
    return pd.factorize(values, sort=True)[0]


def _next(flags: np.ndarray) -> np.ndarray:
    """For each place the first later one with a flag, or the length."""
    n = len(flags)
    later = np.append(np.where(flags, np.arange(n), n)[1:], n)
    return np.minimum.accumulate(later[::-1])[::-1]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a column differs from the place before."""
    found = np.ones(len(columns[0]), dtype=bool)
    found[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return found


class VisitsInOrder(InTimeOrder):
    """Open readings are entries without an exit yet; ``label`` is the device of an exit."""

    KEYS = ("house_id", "area")
    FOUND = ("event_id", "entry_us", "exit_us", "exit_device")

    def __init__(self, longest: int | None) -> None:
        self.longest = longest

    def release(self, open_, ready, passed):
        rows = _together(open_, ready)
        if not len(rows):
            return rows, rows
        opens = rows["opens"].to_numpy(bool)
        group = rows.groupby(list(self.KEYS), sort=False).ngroup().to_numpy()
        # The exits of an instant come before its entries, which they don't close.
        order = np.lexsort((rows["event_id"], _ranked(rows["label"]), opens, rows["us"], group))
        rows, group, opens = rows.iloc[order], group[order], opens[order]
        exit_ = _next(~opens)
        at = np.minimum(exit_, len(rows) - 1)
        closed = opens & (exit_ < len(rows)) & (group[at] == group)
        us, label = rows["us"].to_numpy("int64"), rows["label"].to_numpy(object)
        short = closed if self.longest is None else closed & (us[at] - us <= self.longest)
        found = rows[short].rename(columns={"us": "entry_us"}).assign(exit_us=us[at][short], exit_device=label[at][short])
        waits = opens & ~closed
        if self.longest is not None:
            waits &= us + self.longest > passed
        return found, rows[waits]

    def expires(self, open_):
        return None if self.longest is None or not len(open_) else int(open_["us"].min()) + self.longest


class MovementsInOrder(InTimeOrder):
    """Open readings wait for one in another area; ``label`` is the area.

    All open ones but those of the last instant are of one area: another area would have closed them.
    """

    KEYS = ("house_id",)
    FOUND = ("event_id", "from_area", "to_area", "from_us", "to_us")

    def release(self, open_, ready, passed):
        rows = _together(open_, ready)
        if not len(rows):
            return rows, rows
        group = rows.groupby(list(self.KEYS), sort=False).ngroup().to_numpy()
        area = _ranked(rows["label"])
        order = np.lexsort((rows["event_id"], area, rows["us"], group))
        rows, group, area = rows.iloc[order], group[order], area[order]
        us, last = rows["us"].to_numpy("int64"), len(rows) - 1
        # The next instant if it begins in another area, else the first change of area in or after it.
        instant = _next(_changes(group, us))
        begins = np.minimum(instant, last)
        to = np.where(area[begins] != area, instant, _next(_changes(group, area))[begins])
        at = np.minimum(to, last)
        meets = (instant <= last) & (group[begins] == group) & (to <= last) & (group[at] == group)
        opens = rows["opens"].to_numpy(bool)
        done = opens & meets
        found = rows[done].rename(columns={"us": "from_us", "label": "from_area"})
        return found.assign(to_area=rows["label"].to_numpy(object)[at][done], to_us=us[at][done]), rows[opens & ~meets]


def _watched(stream: DataFrame, delay: str) -> DataFrame:
    """Adds ``at``, the time as an instant (zone-less times are read as UTC), under a watermark."""
    return stream.withColumn("at", F.timestamp_micros(micros(F.col("event_ts")))).withWatermark("at", delay)


def _matched(rows: DataFrame, keys: list[str], parts: Column | None, processor: InTimeOrder, found: str, buckets: int) -> DataFrame:
    """``rows`` with ``opens`` and ``label``, held back and matched; openings lie in one part, the others in all."""
    use_rocksdb(rows.sparkSession)
    ship_package(rows.sparkSession)
    salt = F.lit(0).cast("bigint")
    if parts is not None:
        parts = parts.cast("bigint")
        every = F.sequence(salt, F.coalesce(parts, F.lit(1)) - 1)
        salt = F.explode(F.when(F.col("opens"), F.array(salt_of(F.col("event_id"), parts))).otherwise(every))
    # Marks have no group; a null would make numbers of other groups floats.
    group = [F.coalesce(k, F.lit("0").cast(rows.schema[k].dataType)).alias(k) for k in keys]
    salted = rows.select(
        *group,
        "at",
        "mark",
        "opens",
        "label",
        F.coalesce("event_id", F.lit(-1).cast("bigint")).alias("event_id"),
        micros(F.col("event_ts")).alias("us"),
        salt.alias("salt"),
    )
    # Parts of a group follow each other, so they lie apart.
    bucket = F.pmod(F.pmod(F.xxhash64(*keys), F.lit(buckets)) + F.col("salt"), F.lit(buckets))
    grouped = salted.withColumn("bucket", bucket).groupBy("bucket")
    types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return grouped.transformWithStateInPandas(processor, f"{types}, {found}", "Append", "EventTime")


def visits_in_stream(
    stream: DataFrame,
    delay: str,
    areas: list[str] | None = None,
    longest: int | None = None,
    parts: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """What ``operators.visits.visits`` finds in all readings of the stream: (house_id, area, event_id, entry_ts, exit_ts, exit_device).

    ``longest`` (seconds) leaves out longer visits; entries without an exit leave the state after it.  Without it they stay.
    """
    on_off = F.col("property_device").eqNullSafe(S.PRESENCE) & F.col("value_property_device").isin(S.ON, S.OFF)
    wanted = on_off & F.col("house_id").isNotNull() & (F.col("area").isNotNull() if areas is None else F.col("area").isin(areas))
    entry = F.coalesce(F.col("value_property_device") == S.ON, F.lit(False))
    rows = (
        _watched(stream, delay)
        .withColumn("mark", is_mark())
        .filter(F.col("event_ts").isNotNull() & (F.coalesce(wanted, F.lit(False)) | F.col("mark")))
        .withColumn("opens", entry)
        .withColumn("label", F.when(~entry, F.col("id_device")))
    )
    processor = VisitsInOrder(None if longest is None else longest * 1_000_000)
    found = "event_id bigint, entry_us bigint, exit_us bigint, exit_device string"
    return _matched(rows, ["house_id", "area"], parts, processor, found, buckets).select(
        "house_id",
        "area",
        "event_id",
        from_micros(F.col("entry_us")).alias("entry_ts"),
        from_micros(F.col("exit_us")).alias("exit_ts"),
        "exit_device",
    )


def movements_in_stream(stream: DataFrame, delay: str, parts: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """What ``operators.movement.movements`` finds in all readings of the stream: (house_id, event_id, from_area, to_area, from_ts, to_ts)."""
    wanted = presence_is(S.ON) & F.col("house_id").isNotNull() & F.col("area").isNotNull()
    rows = (
        _watched(stream, delay)
        .withColumn("mark", is_mark())
        .filter(F.col("event_ts").isNotNull() & (F.coalesce(wanted, F.lit(False)) | F.col("mark")))
        .withColumn("opens", ~F.col("mark"))
        .withColumn("label", F.col("area"))
    )
    if parts is not None:
        # Every reading opens in its own part and closes in all of them.
        closes = F.when(~F.col("mark") & (F.coalesce(parts, F.lit(1)) > 1), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.col("opens")))
        rows = rows.select(*[c for c in rows.columns if c != "opens"], F.explode(closes).alias("opens"))
    found = "event_id bigint, from_area string, to_area string, from_us bigint, to_us bigint"
    return _matched(rows, ["house_id"], parts, MovementsInOrder(), found, buckets).select(
        "house_id",
        "event_id",
        "from_area",
        "to_area",
        from_micros(F.col("from_us")).alias("from_ts"),
        from_micros(F.col("to_us")).alias("to_ts"),
    )


def visits_by_join(stream: DataFrame, delay: str, longest: int, areas: list[str] | None = None) -> DataFrame:
    """Visits of at most ``longest`` seconds in built-in operators: entries joined with the exits of the
    time after them, then the first exit of each entry.

    Both sides and the first exits leave the state once the watermark has passed what they wait for.
    An entry meets every exit of its area within ``longest``, so this suits short visits; ``visits_in_stream`` meets one.
    """
    here = F.col("house_id").isNotNull() & (F.col("area").isNotNull() if areas is None else F.col("area").isin(areas))
    here = here & (F.col("property_device") == S.PRESENCE)
    # Conditions that name the time, and a struct as key, are not moved below the watermark, so that marks and other readings move it.
    presence = _watched(stream.filter(F.col("event_ts").isNotNull()), delay)
    place = F.struct("house_id", "area")
    entries = presence.filter((here & (F.col("value_property_device") == S.ON)) | F.col("at").isNull()).select(
        place.alias("place"), "event_id", F.col("at").alias("entry_at")
    )
    exits = presence.filter((here & (F.col("value_property_device") == S.OFF)) | F.col("at").isNull()).select(
        place.alias("exit_place"), F.col("at").alias("exit_at"), "id_device", F.col("event_id").alias("exit_event")
    )
    met = entries.join(
        exits,
        (F.col("place") == F.col("exit_place"))
        & (F.col("exit_at") > F.col("entry_at"))
        & (F.col("exit_at") <= F.col("entry_at") + F.expr(f"INTERVAL '{longest}' SECOND")),
    )
    first = met.groupBy("place", "event_id", "entry_at").agg(F.min(F.struct("exit_at", "id_device", "exit_event")).alias("exit"))
    naive = lambda at: from_micros(F.unix_micros(at))
    return first.select(
        "place.house_id",
        "place.area",
        "event_id",
        naive(F.col("entry_at")).alias("entry_ts"),
        naive(F.col("exit.exit_at")).alias("exit_ts"),
        F.col("exit.id_device").alias("exit_device"),
    )
