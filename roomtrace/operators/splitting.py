"""Splitting of hot groups.

Matching and ranking need the readings of a group (a house, or an area of a
house) in time order.  One window per group is right as long as the group fits
a task, but a single group may hold a large part of the table.  Such groups
are cut here:

1. into equal slices of their time span (``c1``);
2. slices that are still too large (bursts, spans stretched by a few wrong
   clocks) into equal slices of their own span (``c2``, ``c3``, ...), for as many
   rounds as it takes;
3. what is then still too large is one instant, which is *crowded*; the caller
   cuts it by salt or by event id.

The operators carry a small summary from slice to slice, so their results do
not depend on where the cuts fall: the numbers found here steer the load only.

The table of cuts has a row per group above the limit, at most one per
``Limits.rows`` rows of the data.  Up to ``Limits.groups`` rows it passes through
the driver and is broadcast; a longer one is written to the shared folder and
joined by shuffle, so that no group is left whole at any size of the data.
A table without hot groups costs one aggregate, a job of its own that reads the
columns of the keys and the time, and is not cut at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roomtrace.session import work_dir


@dataclass(frozen=True)
class Limits:
    """``rows``: what one task should take of one group.  ``groups``: rows of a table of cuts that may be broadcast."""

    rows: int = 2_000_000
    groups: int = 50_000

    @staticmethod
    def of(spark: SparkSession) -> "Limits":
        return Limits(
            int(spark.conf.get("spark.roomtrace.split.rows", str(Limits.rows))),
            int(spark.conf.get("spark.roomtrace.split.groups", str(Limits.groups))),
        )


# Equal slices hold the limit on average; one up to this many times as large is left as it is.
SLACK = 4


@dataclass(frozen=True)
class Cuts:
    """A table of groups to cut, and whether it is short enough to be broadcast."""

    table: DataFrame
    few: bool


def _too_large(
    df: DataFrame, keys: list[str], over: list[str], limits: Limits, most: int, instants: bool
) -> Cuts | None:
    """The groups of ``keys`` above ``most`` rows, of one instant or of several: ``n``, the number
    of ``parts`` they should be cut into, and for each column of ``over`` its least value and the
    step of a part.  None when there are none.  The aggregate is combined on the map side.
    """
    spans = [f(c).alias(f"{name}_{c}") for c in over for name, f in (("lo", F.min), ("hi", F.max))]
    steps = [F.expr(f"greatest(1, (hi_{c} - lo_{c} + parts) div parts)").alias(f"step_{c}") for c in over]
    found = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), *spans)
        .filter((F.col("n") > most) & ((F.col("lo_us") == F.col("hi_us")) == instants))
        .withColumn("parts", F.ceil(F.col("n") / limits.rows))
        .select("*", *steps)
    )
    first = found.limit(limits.groups + 1).toArrow()
    if first.num_rows <= limits.groups:
        return Cuts(df.sparkSession.createDataFrame(first), True) if first.num_rows else None
    path = work_dir(df.sparkSession, "cuts")
    found.write.parquet(path)
    return Cuts(df.sparkSession.read.parquet(path), False)


def _look_up(df: DataFrame, cuts: Cuts, keys: list[str], values: dict[str, str], how: str) -> DataFrame:
    """Adds ``values`` (new name -> name in the table of cuts); NULL keys match NULL keys."""
    renamed = cuts.table.select(
        *[F.col(k).alias(f"_{k}") for k in keys], *[F.col(v).alias(n) for n, v in values.items()]
    )
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = same if on is None else on & same
    return df.join(F.broadcast(renamed) if cuts.few else renamed, on, how).drop(*[f"_{k}" for k in keys])


class Slices:
    """The cuts of the groups of ``keys`` in ``df``; ``df`` has the time as bigint ``us``."""

    def __init__(self, df: DataFrame, keys: list[str], limits: Limits | None = None, over: list[str] | None = None):
        limits = limits or Limits.of(df.sparkSession)
        over = ["us", *(over or [])]
        self.keys = keys
        self._rounds: list[Cuts] = []
        self._crowded: Cuts | None = None
        most = limits.rows
        if df.groupBy(*keys).count().filter(F.col("count") > most).isEmpty():
            return
        # Every round shortens the spans of what it cuts, down to single instants.
        while (found := _too_large(self._place(df, len(self._rounds)), self.cell, over, limits, most, False)) is not None:
            self._rounds.append(found)
            most = SLACK * limits.rows
        self._crowded = _too_large(self._place(df, 0), self.cell, over, limits, SLACK * limits.rows, True)

    @property
    def cuts(self) -> list[str]:
        """Names of the slice numbers; in their order slices follow each other in time."""
        return [f"c{i}" for i in range(1, len(self._rounds) + 1)]

    @property
    def cell(self) -> list[str]:
        return [*self.keys, *self.cuts]

    @property
    def hot(self) -> bool:
        """Whether any group had to be cut at all."""
        return bool(self._rounds) or self.crowded

    @property
    def crowded(self) -> bool:
        """Whether any slice is still too large."""
        return self._crowded is not None

    def _place(self, df: DataFrame, inner: int) -> DataFrame:
        """Adds the slice numbers.  Only groups cut in each of the first ``inner`` rounds
        are kept; what a round did not cut is its slice 0."""
        keys = list(self.keys)
        for i, (name, table) in enumerate(zip(self.cuts, self._rounds)):
            how = "inner" if i < inner else "left"
            df = _look_up(df, table, keys, {"_lo": "lo_us", "_step": "step_us"}, how)
            df = df.withColumn(name, F.coalesce(F.expr("(us - _lo) div _step"), F.lit(0))).drop("_lo", "_step")
            keys.append(name)
        return df

    def of_hot_groups(self, df: DataFrame) -> DataFrame:
        """Rows of the groups that were cut, with their slice."""
        if not self._rounds:
            return self._place(df, inner=0)
        return self._place(df, inner=0 if self.crowded else 1)

    def of_all(self, df: DataFrame) -> DataFrame:
        """All rows with their slice; groups that were not cut are one slice."""
        return self._place(df, inner=0)

    def crowding(self, df: DataFrame, values: dict[str, str], how: str) -> DataFrame:
        """Adds ``values`` of the crowded slices to rows that have their slice."""
        return _look_up(df, self._crowded, self.cell, values, how)

    def spread(self, df: DataFrame) -> DataFrame:
        """Adds ``parts``, the number of salts of the row's slice (NULL: not crowded)."""
        if not self.crowded:
            return df.withColumn("parts", F.lit(None).cast("bigint"))
        return self.crowding(df, {"parts": "parts"}, "left")


def salt_of(event_id: Column, parts: Column) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(event_id), parts), F.lit(0))


def every_salt(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(parts, F.lit(1)) - 1))
