"""Comparisons carried from day to day, instead of being worked out from the history.

The state of a key at the end of a day is all that later days can ask of the past: its
newest rows, the last row of each period that is still compared with, and the last known
close of an earlier observed period.  A day's report needs the state before it and the
day's rows; a day's state needs the same two.  States are kept as a table with one
partition per day, so that a changed day is repaired from the state before it.

All functions give what :func:`comparison.propagate_as_of` gives for the day.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date as Date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators.comparison import past_name
from tidemark.operators.joins import as_list, attach


@dataclass(frozen=True)
class Carried:
    """What is compared: measures by ``keys`` and the day ``order``, the newest ``days`` rows,
    ``periods`` back from the day, and ``observed`` units."""

    cols: tuple[str, ...]
    keys: tuple[str, ...]
    order: str
    days: tuple[int, ...] = (1, 2, 3, 4)
    periods: tuple[tuple[str, int], ...] = (
        ("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1), ("year", 2),
    )
    observed: tuple[str, ...] = ()

    @classmethod
    def of(cls, cols: str | Sequence[str], keys: str | Sequence[str], order: str, **more) -> Carried:
        return cls(tuple(as_list(cols)), tuple(as_list(keys)), order, **{k: tuple(v) for k, v in more.items()})

    @property
    def depth(self) -> int:
        return max(self.days, default=0)

    @property
    def reach(self) -> dict[str, int]:
        """How many periods of each unit are kept besides the current one."""
        out: dict[str, int] = {}
        for unit, n in self.periods:
            out[unit] = max(n, out.get(unit, 0))
        return out

    def now(self) -> Column:
        return F.struct(p.day_of(self.order).alias("day"), *self.cols)

    def horizon(self, date: DateLike, unit: str) -> Date:
        """The first day of the earliest period that the next day can still ask for."""
        return p.period_bounds(date, unit, self.reach[unit]).start


def state_of(df: DataFrame, what: Carried, date: DateLike) -> DataFrame:
    """The state of every key at the end of a day, from the history: one row per key.

    ``df`` has one row per key and day.  Everything is combined or limited per key before
    the shuffle; what is collected is bounded by the calendar.
    """
    keys, day = list(what.keys), p.day_of(what.order)
    upto = df.where(day <= p.date_lit(date))
    newest = Window.partitionBy(*keys).orderBy(F.desc(what.order))
    ranked = upto.select(*keys, what.now().alias("now"), F.row_number().over(newest).alias("n"))
    kept = ranked.where(F.col("n") <= max(what.depth, 1))
    out = kept.groupBy(*keys).agg(F.sort_array(F.collect_list("now"), asc=False).alias("tail"))

    parts = []
    for unit in what.reach:
        inside = upto.where(day >= F.lit(what.horizon(date, unit)))
        start = p.period_of(day, unit).cast("date")
        parts.append(inside.select(*keys, F.lit(unit).alias("unit"), start.alias("start"), what.now().alias("now")))
    if parts:
        last = reduce(DataFrame.unionByName, parts).groupBy(*keys, "unit", "start").agg(F.max_by("now", "now.day").alias("now"))
        closes = last.groupBy(*keys).agg(F.collect_list(F.struct("unit", "start", "now")).alias("closes"))
        out = attach(out, closes, keys)
    for unit in what.observed:
        start = p.period_of(day, unit).cast("date")
        last = upto.groupBy(*keys, start.alias("start")).agg(F.max_by(what.now(), day).alias("now"))
        seen = last.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start", "now"))).alias("seen"))
        before = F.slice("seen", F.lit(1), F.size("seen") - 1)

        is_open = F.element_at("seen", -1)
        columns = F.struct(is_open["start"].alias("start"), is_open["now"].alias("now"), F.struct(*[_last_known(before, c) for c in what.cols]).alias("closed"))
        out = attach(out, seen.select(*keys, columns.alias(f"observed_{unit}")), keys)
    return _shaped(out, what, df)


def _last_known(closes: Column, c: str) -> Column:
    return F.try_element_at(F.filter(closes, lambda x: x["now"][c].isNotNull()), F.lit(-1))["now"][c].alias(c)


def _shaped(state: DataFrame, what: Carried, df: DataFrame) -> DataFrame:
    """The state's columns in order."""
    lists = ["closes"] if what.reach else []
    return state.select(*what.keys, "tail", *lists, *[f"observed_{u}" for u in what.observed])


def advance(state: DataFrame, rows: DataFrame, what: Carried, date: DateLike) -> DataFrame:
    """The state at the end of a day, from the state before it and the day's rows."""
    keys = list(what.keys)
    now = rows.where(p.day_of(what.order) == p.date_lit(date)).select(*[F.col(k).alias(f"__{k}") for k in keys], what.now().alias("__now"))
    same = reduce(lambda a, b: a & b, [state[k].eqNullSafe(now[f"__{k}"]) for k in keys])
    both = state.join(now, same, "full")
    # A null key is told from a missing side by the side itself.
    fresh = F.col("__now").isNotNull()
    key = [F.when(fresh, F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    tail = F.concat(F.array("__now"), F.coalesce("tail", F.slice(F.array("__now"), 1, 0)))
    made = [F.when(fresh, F.slice(tail, 1, max(what.depth, 1))).otherwise(F.col("tail")).alias("tail")]
    if what.reach:
        starts = {u: p.period_start(date, u) for u in what.reach}
        mine = F.array(*[F.struct(F.lit(u).alias("unit"), F.lit(s).alias("start"), F.col("__now").alias("now")) for u, s in starts.items()])
        old = F.coalesce("closes", F.slice(mine, 1, 0))
        current = lambda x: reduce(or_, [(x["unit"] == u) & (x["start"] == F.lit(s)) for u, s in starts.items()])
        near = lambda x: reduce(or_, [(x["unit"] == u) & (x["start"] >= F.lit(what.horizon(date, u))) for u in starts])
        others = F.filter(old, lambda x: ~current(x))
        made.append(F.filter(F.when(fresh, F.concat(mine, others)).otherwise(old), near).alias("closes"))
    for unit in what.observed:
        start = F.lit(p.period_start(date, unit))
        closed = F.struct(*[_closed(what, unit, c, start).alias(c) for c in what.cols])
        new = F.struct(start.alias("start"), F.col("__now").alias("now"), closed.alias("closed"))
        made.append(F.when(fresh, new).otherwise(F.col(f"observed_{unit}")).alias(f"observed_{unit}"))
    return _shaped(both.select(*key, *made), what, rows)


def _closed(what: Carried, unit: str, c: str, start: Column) -> Column:
    """The last known close as a row in the period from ``start`` on sees it."""
    had = F.col(f"observed_{unit}")
    passed = (had["start"] != start) & had["now"][c].isNotNull()
    return F.when(passed, had["now"][c]).otherwise(had["closed"][c])


def _close(unit: str, start: Date) -> Column:
    """The last row of one period."""
    return F.get(F.filter("closes", lambda x: (x["unit"] == unit) & (x["start"] == F.lit(start))), F.lit(0))


def report(
    rows: DataFrame, before: DataFrame, what: Carried, date: DateLike, same_day: DataFrame | None = None
) -> DataFrame:
    """The rows of a day with their comparison columns, from the state before the day.

    ``same_day``, rows of the same day last year, adds ``same_day_last_year_x``.
    """
    today = rows.where(p.day_of(what.order) == p.date_lit(date))
    out = attach(today, before, list(what.keys))
    made = []
    for c in what.cols:
        made += [F.get(F.col("tail"), F.lit(n - 1))[c].alias(past_name(c, "day", n)) for n in what.days]
        for unit, n in what.periods:
            close = _close(unit, p.period_bounds(date, unit, n).start)
            made.append(close["now"][c].alias(past_name(c, unit, n)))
        made += [_closed(what, unit, c, F.lit(p.period_start(date, unit))).alias(past_name(c, unit)) for unit in what.observed]
    out = out.select(*rows.columns, *made)
    if same_day is None:
        return out
    then = same_day.where(p.day_of(what.order) == p.date_lit(p.shift_back(date, "year", 1)))
    named = then.groupBy(*what.keys).agg(*[F.max(c).alias(f"same_day_last_year_{c}") for c in what.cols])
    return attach(out, named, list(what.keys))


def state_on(spark: SparkSession, folder: str, date: DateLike) -> DataFrame:
    """The written state at the end of a day: one partition is read."""
    return spark.read.parquet(f"{folder}/day={p.as_date(date)}")


def carry_forward(
    source: DataFrame,
    what: Carried,
    folder: str,
    dates: Iterable[Date],
    first: Date | None = None,
    known: Date | None = None,
) -> None:
    """Writes the states of the snapshot ``dates`` from ``first`` on (all by default).

    ``known`` is the last day before them whose state is written.  Without it the first
    state is made from the history; each further one reads the state before it and one
    day's rows.  After a change of day ``d`` call it with ``first=d``; every later state is
    replaced.  A run that fails is taken up from the last state that it wrote.
    """
    spark = source.sparkSession
    for day in sorted(d for d in dates if first is None or d >= first):
        if known is None:
            state = state_of(source, what, day)
        else:
            state = advance(state_on(spark, folder, known), source, what, day)
        state.write.mode("overwrite").parquet(f"{folder}/day={day}")
        known = day
