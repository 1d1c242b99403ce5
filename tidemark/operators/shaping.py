"""Enriching, matching and reshaping tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import UNKNOWN_NUMBER, UNKNOWN_TEXT
from tidemark.operators.joins import as_list, dealt

# --- unknown members ---------------------------------------------------------------


def _unknown(kind: T.DataType) -> Column:
    if isinstance(kind, T.NumericType):
        return F.lit(UNKNOWN_NUMBER).cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit(UNKNOWN_TEXT)
    return F.lit(None).cast(kind)


def with_unknown_member(dimension: DataFrame) -> DataFrame:
    """The dimension plus one row that stands for "unknown": -1 or ``'-1'``."""
    fields = dimension.schema.fields
    row = dimension.sparkSession.range(1).select(
        *[_unknown(f.dataType).alias(f.name) for f in fields]
    )
    return dimension.unionByName(row)


def fill_unknown(fact: DataFrame) -> DataFrame:
    """Nulls of a fact become -1 in numeric columns and ``'-1'`` in text columns."""
    return fact.fillna(UNKNOWN_NUMBER).fillna(UNKNOWN_TEXT)


# --- joins ---------------------------------------------------------------------------

#: Rows of a key in a share of the second table and of the rows that are left for it, and
#: the shares of rows whose key the second table does not have.
SECOND_SHARE, LEFT_SHARE, UNMATCHED_SHARES = 256, 8192, 1024


@dataclass
class Dimension:
    """One dimension of a star: its key columns, what to take and how to join.

    ``on`` maps fact columns to dimension columns.
    """

    df: DataFrame
    on: dict[str, str]
    take: dict[str, str] = field(default_factory=dict)
    how: str = "left"


def star_enrich(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Join a fact with its dimensions, one after the other, in the given order.

    ``take`` maps the new column to the dimension's column.
    """
    out = fact
    for i, dim in enumerate(dimensions):
        keys = {fact_col: f"__d{i}_{dim_col}" for fact_col, dim_col in dim.on.items()}
        side = dim.df.select(
            *[F.col(dim_col).alias(keys[fact_col]) for fact_col, dim_col in dim.on.items()],
            *[F.col(source).alias(name) for name, source in dim.take.items()],
        )
        match = reduce(
            lambda a, b: a & b, [out[fact_col] == side[key] for fact_col, key in keys.items()]
        )
        out = out.join(side, match, dim.how)
        if dim.how not in ("left_semi", "left_anti"):
            out = out.drop(*keys.values())
    return out


def flatten_hierarchy(
    units: DataFrame,
    code: str,
    name: str,
    levels: dict[str, str],
    fallback: Sequence[str] = (),
) -> DataFrame:
    """Put the names of a unit's parents next to it.

    ``units`` refers to itself: ``levels`` maps a level to the column with the code
    of the parent on that level.  Adds ``<level>_code`` and ``<level>_name``.  A
    level in ``fallback`` may be missing and is then the unit itself; a unit
    without one of the other parents is left out.
    """
    out = units
    for level, parent in levels.items():
        named = units.select(
            F.col(code).alias(f"__{level}"), F.col(name).alias(f"__{level}_name")
        )
        how = "left" if level in fallback else "inner"
        out = out.join(named, out[parent] == named[f"__{level}"], how)
    made = []
    for level, parent in levels.items():
        if level in fallback:
            made.append(F.coalesce(F.col(parent), F.col(code)).alias(f"{level}_code"))
            made.append(F.coalesce(F.col(f"__{level}_name"), F.col(name)).alias(f"{level}_name"))
        else:
            made.append(F.col(parent).alias(f"{level}_code"))
            made.append(F.col(f"__{level}_name").alias(f"{level}_name"))
    return out.select(*units.columns, *made)


def leaf_units(units: DataFrame, code: str, parent: str) -> DataFrame:
    """Units that are nobody's parent."""
    parents = units.where(F.col(parent).isNotNull()).select(F.col(parent).alias("__parent"))
    return units.join(parents, units[code] == parents["__parent"], "left_anti")


def unmatched_rows(
    df: DataFrame, references: Sequence[tuple[DataFrame, dict[str, str]]]
) -> DataFrame:
    """Rows found in none of the reference tables.

    Each reference comes with the map from the row's columns to its own.  An anti
    join keeps rows with null keys, unlike ``NOT IN``.
    """
    out = df
    for ref, on in references:
        keyed = ref.select(*[F.col(r).alias(f"__{r}") for r in on.values()])
        match = reduce(lambda a, b: a & b, [out[c] == keyed[f"__{r}"] for c, r in on.items()])
        out = out.join(keyed, match, "left_anti")
    return out


def enrich_with_fallback(
    df: DataFrame,
    first: DataFrame,
    second: DataFrame,
    first_on: dict[str, str],
    second_on: dict[str, str],
    take: Sequence[str],
) -> DataFrame:
    """Take columns from ``first``; rows it does not know take them from ``second``.

    Both have the columns ``take``.  ``second`` is only matched for rows that
    ``first`` has left over, so a row known to both is not multiplied.  Adds
    ``matched_by`` (1, 2 or null).

    A key with many rows on both sides of the second match gives their product.  Both are
    dealt into shares, so that no task has a whole key, and rows come out share by share:
    a share of ``second`` repeats at short distance, which files store small.
    """

    def side(source: DataFrame, on: dict[str, str], tag: str) -> DataFrame:
        return source.select(
            *[F.col(c).alias(f"__{tag}_{c}") for c in on.values()],
            *[F.col(c).alias(f"__{tag}_take_{c}") for c in take],
            F.lit(True).alias(f"__{tag}"),
        )

    def match(left: DataFrame, on: dict[str, str], tag: str) -> Column:
        return reduce(lambda a, b: a & b, [left[c] == F.col(f"__{tag}_{r}") for c, r in on.items()])

    def taken(tag: str, matched_by: Column) -> list[Column]:
        values = [F.col(f"__{tag}_take_{c}").alias(c) for c in take]
        return [*[df[c] for c in df.columns], *values, matched_by.alias("matched_by")]

    a, b = side(first, first_on, "a"), side(second, second_on, "b")
    known = df.join(a, match(df, first_on, "a")).select(*taken("a", F.lit(1)))
    left = df.join(a.select([f"__a_{c}" for c in first_on.values()]), match(df, first_on, "a"), "left_anti")

    rows = df.groupBy(*[F.col(c).alias(f"__s_{r}") for c, r in second_on.items()]).agg(F.count("*").alias("__rows"))
    sizes = b.groupBy(*[f"__b_{r}" for r in second_on.values()]).agg(F.count("*").alias("__size"))
    same = [F.col(f"__b_{r}") == F.col(f"__s_{r}") for r in second_on.values()]
    shares = sizes.join(rows, reduce(lambda x, y: x & y, same)).select(
        *[f"__s_{r}" for r in second_on.values()],
        F.ceil(F.col("__size") / SECOND_SHARE).alias("__shares"),
        F.ceil(F.col("__rows") / LEFT_SHARE).alias("__left_shares"),
    )
    # Rows without a match may be in any share.
    pairs = left.join(shares, match(left, second_on, "s"), "left").select(
        *[left[c] for c in left.columns],
        "__shares",
        _share(left, F.coalesce("__left_shares", F.lit(UNMATCHED_SHARES))).alias("__left_share"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__shares", F.lit(1)) - 1)).alias("__share"),
    )
    shared = b.join(shares, reduce(lambda x, y: x & y, same)).select(
        *shares.columns[: len(same)],
        *b.columns,
        _share(b, F.col("__shares")).alias("__b_share"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("__left_shares") - 1)).alias("__b_left_share"),
    )
    pairs = dealt(pairs, *second_on, "__share", "__left_share")
    alike = (F.col("__share") == F.col("__b_share")) & (F.col("__left_share") == F.col("__b_left_share"))
    # A merge join hands out the rows of a share together.
    others = pairs.join(shared.hint("merge"), match(pairs, second_on, "s") & alike, "left")
    # A share may be empty; a row is without a match only if its key has no share at all.
    others = others.where(F.col("__b").isNotNull() | F.col("__shares").isNull())
    return known.union(others.select(*taken("b", F.when(F.col("__b").isNotNull(), 2))))


def _share(df: DataFrame, shares: Column) -> Column:
    """The share, from 0, that a row falls to by its values."""
    values = [F.col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return F.pmod(F.xxhash64(*values), shares)


def priority_lookup(
    df: DataFrame,
    maps: dict[str, tuple[DataFrame, str, str]],
    take: dict[str, str],
    upper: bool = True,
    override: tuple[str, Callable[[Callable[[str, str], Column]], Column]] | None = None,
) -> DataFrame:
    """Values from the first of several lookup tables that knows them.

    ``maps`` lists, by priority, ``name -> (table, key in df, key in table)`` with
    one row per key.  ``take`` maps a
    column of the tables to its default.
    ``override = (name, rule)`` prefers that table where the rule holds; the rule
    gets a function ``(table name, column) -> Column``.
    """
    out = df
    for name, (table, key, table_key) in maps.items():
        side = table.select(
            F.col(table_key).alias(f"__{name}_key"),
            *[F.col(c).alias(f"__{name}_{c}") for c in take],
        )
        out = out.join(side, out[key] == side[f"__{name}_key"], "left")

    def looked_up(name: str, column: str) -> Column:
        return F.col(f"__{name}_{column}")

    made = []
    for column, default in take.items():
        choices = [looked_up(name, column) for name in maps]
        if override:
            chosen, rule = override
            choices.insert(0, F.when(rule(looked_up), looked_up(chosen, column)))
        value = F.coalesce(*choices, F.lit(default))
        made.append((F.upper(value) if upper else value).alias(column))
    return out.select(*[df[c] for c in df.columns], *made)


def full_outer_rules(
    left: DataFrame, right: DataFrame, keys: str | Sequence[str], *rules: Column
) -> DataFrame:
    """Full outer join on the keys, keeping rows for which any rule holds.

    The keys are those of whichever side has the row.
    """
    joined = left.join(right, as_list(keys), "full")
    return joined.where(reduce(lambda a, b: a | b, rules)) if rules else joined


# --- reshaping ----------------------------------------------------------------------


def parse_json(
    df: DataFrame, col: str, schema: T.StructType, rename: dict[str, str] | None = None
) -> DataFrame:
    """Fields of a JSON text column as columns; bad JSON gives nulls.

    ``rename`` maps field names (which may contain spaces) to column names.
    """
    rename = rename or {}
    parsed = F.from_json(F.col(col), schema)
    others = [c for c in df.columns if c != col]
    return df.select(
        *others,
        *[parsed.getField(f.name).alias(rename.get(f.name, f.name)) for f in schema.fields],
    )


def pivot_counts(
    df: DataFrame,
    keys: str | Sequence[str],
    col: str,
    values: Sequence[str],
    aggs: dict[str, Column] | None = None,
    fill: Sequence[str] = ("count",),
) -> DataFrame:
    """Aggregates per key with one column per listed value, ``<value>_<name>``.

    Columns of the aggregates in ``fill`` show 0 where the key has no such row.
    """
    aggs = aggs or {"count": F.count(F.lit(1))}
    pivoted = df.groupBy(*as_list(keys)).pivot(col, list(values)).agg(
        *[agg.alias(name) for name, agg in aggs.items()]
    )
    if len(aggs) == 1:
        name = next(iter(aggs))
        pivoted = pivoted.withColumnsRenamed({v: f"{v}_{name}" for v in values})
    return pivoted.fillna(0, [f"{v}_{name}" for v in values for name in fill])


def routed_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name of differently shaped parts; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def route(df: DataFrame, rules: dict[str, Column], name: str = "route") -> DataFrame:
    """Name of the first rule that holds for a row; rows without one are dropped.

    For routes over one fact this replaces a union of filtered copies: the fact is
    read once, not once per route.
    """
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, rule in rules.items():
        chosen = chosen.when(rule, F.lit(label))
    return df.withColumn(name, chosen).where(F.col(name).isNotNull())
