"""Windows over a long history of one key, in parallel.

A window brings all rows of a key to one task.  Here the history of a key with more than
``hot_rows`` rows is cut into ranges of its order, its *segments*, by approximate quantiles.
Each segment is worked through by itself; its last row is its closing state.  The states of
a key, at most ``segments`` of them, are combined from the left, which tells every segment
what stands before it, and the segments' own results are completed with that.  Keys with
fewer rows have no segments and are done by the window alone.

Which keys are cut changes no result.  Rows of one key that are equal in their order stay in
one segment; as in any window, their order among each other is not defined.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.operators.joins import as_list, attach, dealt

#: Rows of a key from which on its history is cut, and into how many segments.
HOT_ROWS, SEGMENTS = 1_000_000, 256
SEGMENT = "__segment"
_PLACE = "__place"
_LINE = 16


class Lag(NamedTuple):
    """The value of ``by`` so many rows earlier."""

    name: str
    by: str
    n: int


class Pick(NamedTuple):
    """The latest value of ``by`` among the key's rows where ``inside`` holds, in the rows
    where ``shown`` holds."""

    name: str
    by: str
    inside: Column
    shown: Column


class Observed(NamedTuple):
    """The last value of ``by`` in the previous period in which the key has rows; with
    ``exact`` only if that is the period directly before."""

    name: str
    by: str
    unit: str
    exact: bool = False


def with_segments(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str,
    hot_rows: int = HOT_ROWS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """``df`` with the number of each row's segment, null for keys of up to ``hot_rows`` rows.

    ``order`` is a number, date or timestamp; rows without one are in the first segment.
    """
    keys = as_list(keys)
    steps = [i / segments for i in range(1, segments)] or [0.5]
    bounds = F.percentile_approx(order, steps, 20 * segments)
    # Counted and sketched at once, before the exchange: no task reads the rows of a whole key.
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), bounds.alias("__bounds")).where(F.col("__rows") > hot_rows)
    # In lines, so that a row is compared with two short lists and not with all bounds.
    lines = F.array(*[F.slice("__bounds", i + 1, _LINE) for i in range(0, len(steps), _LINE)])
    out = attach(df, found.select(*keys, lines.alias("__lines")), keys)
    below = lambda values, of: F.size(F.filter(values, lambda b: of(b) < F.col(order)))
    whole = below("__lines", lambda line: F.element_at(line, -1))
    rest = F.coalesce(F.get("__lines", whole), F.slice(F.get("__lines", F.lit(0)), 1, 0))
    number = whole * _LINE + below(rest, lambda b: b)
    return out.withColumn(SEGMENT, F.when(F.col("__lines").isNotNull(), number)).drop("__lines")


def compare_in_segments(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str,
    lags: Sequence[Lag] = (),
    picks: Sequence[Pick] = (),
    observed: Sequence[Observed] = (),
    hot_rows: int = HOT_ROWS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """``df`` with the columns asked for; one exchange of the rows for all of them.

    Rows of a segment are numbered and compared among themselves first.  What reaches back
    over the segment's beginning is taken from the states: the last values of earlier rows,
    the last close of an earlier period, and the latest value of the whole key.
    """
    keys = as_list(keys)
    # Dealt before the windows' inputs are worked out, which are many times the rows.
    rows = _placed(with_segments(df, keys, order, hot_rows, segments), keys).drop(SEGMENT).repartition(_PLACE)
    own = Window.partitionBy(_PLACE)
    ordered = own.orderBy(order)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    depth = max((x.n for x in lags), default=0)
    bys = sorted({x.by for x in lags})
    units = sorted({x.unit for x in observed})

    period = {u: p.period_of(p.day_of(order), u) for u in units}
    tails = [F.lag(b, n).over(ordered).alias(f"__lag{n}_{b}") for b in bys for n in range(1, depth + 1)]
    # In one expression, as a filter on the segment alone would make the states' exchange another.
    closes = F.when(F.col(_PLACE)[SEGMENT].isNotNull(), F.lead(F.lit(1)).over(ordered).isNull())
    made = [F.row_number().over(ordered).alias("__n"), closes.alias("__closing")]
    made += [period[u].alias(f"__period_{u}") for u in units]
    made += [F.first(period[u]).over(running).alias(f"__first_{u}") for u in units]
    for i, x in enumerate(observed):
        made.append(F.last(_closing(F.lag(period[x.unit]).over(ordered), F.lag(x.by).over(ordered), period[x.unit], x), ignorenulls=True).over(running).alias(f"__closed{i}"))
    for i, x in enumerate(picks):
        made.append(F.max(F.when(x.inside, F.struct(F.col(order).alias("at"), F.col(x.by).alias("value")))).over(own).alias(f"__picked{i}"))
        made.append(F.max(x.shown).over(own).alias(f"__shown{i}"))
    rows = rows.select("*", *tails, *made)

    out = rows.join(_before(rows, keys, bys, depth, picks, observed), _PLACE, "left")
    final = []
    for x in lags:
        here, reach = F.col(f"__lag{x.n}_{x.by}"), F.lit(x.n) - F.col("__n")
        final.append(F.when(reach < 0, here).otherwise(F.get(F.col(f"__tail_{x.by}"), reach)).alias(x.name))
    for i, x in enumerate(picks):
        final.append(F.when(x.shown, F.coalesce(f"__whole{i}", f"__picked{i}")["value"]).alias(x.name))
    for i, x in enumerate(observed):
        close = F.coalesce(f"__closed{i}", f"__before{i}")
        value = close["value"]
        if x.exact:
            value = F.when(close["period"] == p.previous_period_of(p.day_of(order), x.unit), value)
        final.append(value.alias(x.name))
    return out.select(*df.columns, *final)


def _placed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """With key and segment as one value, by which windows and joins are dealt alike: rows go
    on to a join where the window left them.  Nulls in it are equal."""
    return rows.withColumn(_PLACE, F.struct(*keys, SEGMENT))


def _closing(before: Column, value: Column, period: Column, x: Observed) -> Column:
    """The close of the period before, in the first row of a period."""
    known = F.lit(True) if x.exact else value.isNotNull()
    return F.when((period != before) & known, F.struct(before.alias("period"), value.alias("value")))


def _before(
    rows: DataFrame, keys: list[str], bys: list[str], depth: int, picks: Sequence[Pick], observed: Sequence[Observed]
) -> DataFrame:
    """What stands before each segment, from the last rows of the segments."""
    closing = rows.where("__closing")
    mine = lambda b: F.slice(F.array(b, *[f"__lag{n}_{b}" for n in range(1, depth)]), F.lit(1), F.least("__n", F.lit(depth)))
    closing = closing.select(
        *keys,
        F.col(_PLACE)[SEGMENT].alias(SEGMENT),
        *[mine(b).alias(f"__mine_{b}") for b in bys],
        *[x for i in range(len(picks)) for x in (f"__picked{i}", f"__shown{i}")],
        *[f"__closed{i}" for i in range(len(observed))],
        *[f"__first_{u}" for u in sorted({x.unit for x in observed})],
        *[F.struct(F.col(f"__period_{x.unit}").alias("period"), F.col(x.by).alias("value")).alias(f"__end{i}") for i, x in enumerate(observed)],
    ).repartition(*keys)
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT)
    upto = earlier.rowsBetween(Window.unboundedPreceding, -1)
    made = []
    for b in bys:
        own = F.col(f"__mine_{b}")
        # A segment has a row at least, so the values reached for lie in so many segments.
        back = [F.coalesce(F.lag(own, n).over(earlier), F.slice(own, 1, 0)) for n in range(1, depth + 1)]
        made.append(F.slice(F.concat(*back), 1, depth).alias(f"__tail_{b}"))
    for i in range(len(picks)):  # for the segments that show it
        whole = F.max(f"__picked{i}").over(Window.partitionBy(*keys))
        made.append(F.when(F.col(f"__shown{i}"), whole).alias(f"__whole{i}"))
    for i, x in enumerate(observed):
        last = F.lag(f"__end{i}").over(earlier)
        made.append(_closing(last["period"], last["value"], F.col(f"__first_{x.unit}"), x).alias(f"__entry{i}"))
    found = closing.select(*keys, SEGMENT, *[f"__closed{i}" for i in range(len(observed))], *made)
    kept = [c for c in found.columns if c.startswith(("__tail_", "__whole"))]
    closes = []
    for i in range(len(observed)):
        after = F.coalesce(f"__closed{i}", f"__entry{i}")
        closes.append(F.coalesce(f"__entry{i}", F.last(after, ignorenulls=True).over(upto)).alias(f"__before{i}"))
    return _placed(found.select(*keys, SEGMENT, *kept, *closes), keys).drop(*keys, SEGMENT)


def nearest_known(
    df: DataFrame,
    known: DataFrame,
    keys: str | Sequence[str],
    order: str,
    values: Sequence[str],
    prefer: str = "next",
    hot_rows: int = HOT_ROWS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """``df`` with each of ``values`` as ``known`` (keys, order, values) has it nearest: at the
    row's own place in the order, else at the next one (or the ``previous``, as ``prefer``
    says), else on the other side; null where the key has none.

    This is an as-of join by one merged stream of both tables, without a row for every key
    and day.  Nulls among the values are passed over, each value by itself.  The history of
    a hot key is cut into segments, whose nearest values outside come from the states.  Of
    several known rows in one place the largest value counts.
    """
    keys = as_list(keys)
    have = known.groupBy(*keys, order).agg(*[F.max(v).alias(v) for v in values])
    here = lambda v: F.when(F.col(v).isNotNull(), F.struct(F.col(v).alias("value")))
    shape = df.select(*keys, order).schema
    quotes = have.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in shape], F.lit(0).alias("__side"), *[here(v).alias(f"__{v}") for v in values]
    )
    asks = df.select(*keys, order, F.lit(1).alias("__side"), F.struct(*df.columns).alias("__row"))
    merged = with_segments(quotes.unionByName(asks, allowMissingColumns=True), keys, order, hot_rows, segments)
    stream = dealt(_placed(merged, keys), _PLACE)

    own = Window.partitionBy(_PLACE)
    behind = own.orderBy(F.col(order).asc_nulls_first(), "__side")
    ahead = own.orderBy(F.col(order).desc_nulls_last(), "__side")
    back = lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = stream.select(
        "*", *[back(f"__{v}", behind).alias(f"__prev_{v}") for v in values], *[back(f"__{v}", ahead).alias(f"__next_{v}") for v in values]
    )

    at = lambda v: F.when(F.col(f"__{v}").isNotNull(), F.struct(F.col(order).alias("at"), F.col(f"__{v}").alias("known")))
    cut = merged.where(F.col(SEGMENT).isNotNull())
    # Only known rows are sorted for the states; the others tell which segments there are.
    told = cut.where("__side = 0").select(*keys, SEGMENT, order, *[f"__{v}" for v in values])
    states = cut.select(*keys, SEGMENT).distinct().unionByName(told, allowMissingColumns=True).groupBy(*keys, SEGMENT).agg(
        *[F.max(at(v)).alias(f"__max_{v}") for v in values], *[F.min(at(v)).alias(f"__min_{v}") for v in values]
    )
    whole = Window.partitionBy(*keys).orderBy(SEGMENT)
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    after = whole.rowsBetween(1, Window.unboundedFollowing)
    outside = _placed(states, keys).select(
        _PLACE,
        *[F.last(f"__max_{v}", ignorenulls=True).over(before)["known"].alias(f"__before_{v}") for v in values],
        *[F.first(f"__min_{v}", ignorenulls=True).over(after)["known"].alias(f"__after_{v}") for v in values],
    )
    out = rows.where("__side = 1").join(outside, _PLACE, "left")

    def nearest(v: str) -> Column:
        following = [F.col(f"__next_{v}"), F.col(f"__after_{v}")]
        preceding = [F.col(f"__prev_{v}"), F.col(f"__before_{v}")]
        ways = [*following, *preceding] if prefer == "next" else [*preceding, *following]
        return F.coalesce(*ways)["value"].alias(v)

    return out.select("__row.*", *[nearest(v) for v in values])
