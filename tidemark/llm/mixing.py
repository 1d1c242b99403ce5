"""Mixing sources to target weights by Pfair scheduling.

Every source has a weight in whole parts of ``PARTS``.  The i-th block of a source with
weight w is released at ``floor((i - 1) / w)`` and due at ``ceil(i / w)``; in every slot the
released block that is due first goes next.  Then no source is a whole block ahead of or
behind its weight at any time.  The pattern repeats after ``PARTS`` slots, so it is worked
out once for every set of sources that still have rows at the start of a period; when one
runs out, the others go on with their own windows and the slots left free are passed over.

The place of a row follows from its number within its source in closed form: nothing is
ordered as a whole.  Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import id_blocks
from tidemark.llm.shared import partitions

PARTS = 1000
BLOCK_ROWS = 8
OTHER = "other"
#: Shares of the training text by source in the queries; the others have the rest.
WEIGHTS = {"src0": 0.25, "src1": 0.1, "src2": 0.1, "src3": 0.1, OTHER: 0.45}
#: Parts of a pattern for each stream at least, so that many small weights keep their size.
PARTS_EACH = 4
#: Tables whose size is known to be less are broadcast; above it the join is Spark's choice.
BROADCAST_BYTES = 32 << 20


def _small(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def parts_for(weights: dict[str, float]) -> int:
    """Parts of the pattern of so many streams."""
    return max(PARTS, PARTS_EACH * len(weights))


def whole_parts(weights: dict[str, float], parts: int = PARTS) -> dict[str, int]:
    """Weights as whole parts that sum up to ``parts``: rounded down, at least one, and the
    rest to the largest remainders."""
    total = sum(weights.values())
    if not weights or len(weights) > parts or min(weights.values()) <= 0:
        raise ValueError("weights must be positive and no more than the parts")
    exact = {s: w / total * parts for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    while sum(out.values()) < parts:
        for s in order[: parts - sum(out.values())]:
            out[s] += 1
    while sum(out.values()) > parts:
        out[max(out, key=lambda s: (out[s] - exact[s] if out[s] > 1 else -1, s))] -= 1
    return out


def _stream(source: Column, names: list[str]) -> Column:
    """The number of a row's stream: that of its source's name, or of the others."""
    other = names.index(OTHER)
    own = F.array_position(F.array(*[F.lit(n) for n in names]), F.coalesce(source, F.lit(OTHER)))
    return F.when(own > 0, own - 1).otherwise(other).cast("int")


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def schedule(docs: DataFrame, parts: dict[str, int], rows: dict[str, int], block_rows: int) -> DataFrame:
    """(phase, stream, nth, slot, before): the slot of a period in which a stream's nth
    block (from 0) of that period goes, for every set of streams that still have rows at
    the start of a period (a phase), and how many blocks of each stream go before it."""
    names = list(parts)
    k, total = len(names), sum(parts.values())
    ends = [_periods(rows[s], parts[s] * block_rows) for s in names]
    phases = sorted({0, *[e for e in ends if e]} - {max(ends)}) or [0]
    table = docs.sparkSession.range(len(phases)).select(F.col("id").cast("int").alias("phase"))
    starts = _longs(phases)
    active = F.transform(_longs(ends), lambda e: e > F.element_at(starts, F.col("phase") + 1))
    share = _longs([parts[s] for s in names])
    streams = F.sequence(F.lit(0), F.lit(k - 1))

    def candidate(state: Column, t: Column, j: Column) -> Column:
        done, w = F.get(state["done"], j), F.get(share, j)
        release = F.floor(done * total / w)
        due = F.ceil((done + 1) * total / w)
        free = F.get(F.col("active"), j) & (done < w) & (release <= t)
        return F.when(free, F.struct(due.cast("long").alias("due"), j.alias("stream")))

    def step(state: Column, t: Column) -> Column:
        best = F.array_min(F.transform(streams, lambda j: candidate(state, t, j)))["stream"]
        nth = F.get(state["done"], best)
        pick = F.struct(
            F.coalesce(best, F.lit(-1)).alias("stream"),
            F.coalesce(nth, F.lit(-1).cast("long")).alias("nth"),
            t.cast("long").alias("slot"),
            state["done"].alias("before"),
        )
        done = F.transform(state["done"], lambda d, j: d + F.coalesce((j == best).cast("long"), F.lit(0)))
        return F.struct(done.alias("done"), F.concat(state["picks"], F.array(pick)).alias("picks"))

    kind = "struct<done:array<bigint>,picks:array<struct<stream:int,nth:bigint,slot:bigint,before:array<bigint>>>>"
    zero = F.struct(_longs([0] * k).alias("done"), F.array().alias("picks")).cast(kind)
    folded = F.aggregate(
        F.sequence(F.lit(0), F.lit(total - 1)), zero, lambda s, t: step(s, t).cast(kind)
    )
    picks = table.withColumn("active", active).select("phase", F.explode(folded["picks"]).alias("p"))
    return picks.select("phase", "p.*").where("stream >= 0")


def _periods(rows: int, per_period: int) -> int:
    """Periods that a stream's rows last, the last one maybe in part."""
    return -(-rows // per_period)


def numbered(docs: DataFrame, group: Column, key: str, streams: int) -> DataFrame:
    """``docs`` with ``_stream`` and ``_n``, the number of a row (from 0) in its stream by
    ascending key (null first).  A stream is numbered in ranges of keys, whose sizes are
    summed up first, so that no task orders a whole stream."""
    blocks = id_blocks(docs, key)
    placed = docs.withColumns({"_stream": group, "_range": blocks.native(key)})
    sizes = placed.groupBy("_stream", "_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_stream").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("_stream").alias("_s"),
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("_stream", "_range").orderBy(F.col(key).asc_nulls_first())
    rows = placed.withColumn("_i", F.row_number().over(inside) - 1)
    return rows.join(
        # A row per stream and range at most.
        _small(sizes, 32 * streams * blocks.count), (F.col("_stream") == F.col("_s")) & (F.col("_range") == F.col("_r"))
    ).withColumn("_n", (F.col("_before") + F.col("_i")).cast("long")).drop("_range", "_s", "_r", "_before", "_i")


def mixed(
    docs: DataFrame, weights: dict[str, float], block_rows: int = BLOCK_ROWS, parts: int | None = None, source: str = "source"
) -> DataFrame:
    """``docs`` (doc_id, source, ...) with the columns ``mix_stream`` (number of the stream in
    the order of ``weights``), ``mix_block`` (from 0), ``mix_release``, ``mix_due``,
    ``mix_slot`` and ``mix_position``, the gapless place of the row in the mix.

    ``weights`` maps sources to weights; ``"other"`` stands for all sources not named, null
    ones included.  Rows of a source go by doc_id, null first, rows of equal doc_id in any
    order.  All rows are kept: a source that runs out leaves its share to the others.  Columns
    with the new names are replaced.  An empty table gives an empty one.
    """
    weights = weights if OTHER in weights else {**weights, OTHER: 1e-9}
    share = whole_parts(weights, parts or parts_for(weights))
    names = list(share)
    total = sum(share.values())
    group = _stream(F.col(source), names)
    found = {r[0]: r[1] for r in docs.groupBy(group.alias("s")).count().collect()}
    rows = {s: found.get(i, 0) for i, s in enumerate(names)}
    if not any(rows.values()):
        return _with_places(docs, *[F.lit(0).cast("long")] * 6)
    ends = [_periods(rows[s], share[s] * block_rows) for s in names]
    starts = sorted({0, *[e for e in ends if e]} - {max(ends)}) or [0]
    pattern = schedule(docs, share, rows, block_rows).select(
        *[F.col(c).alias(f"_mix_{c}") for c in ("phase", "stream", "nth", "slot", "before")]
    )
    part = F.get(_longs([share[s] for s in names]), F.col("_stream"))
    block = F.floor(F.col("_n") / block_rows).cast("long")
    period = F.floor(block / part).cast("long")
    phase = F.size(F.filter(_longs(starts), lambda p: p <= period)) - 1
    keyed = numbered(docs, group, "doc_id", len(names)).withColumns(
        {"_block": block, "_period": period, "_phase": phase, "_nth": block % part}
    )
    # A row per part and phase, each with a number per stream.
    joined = keyed.join(
        _small(pattern, total * len(starts) * (48 + 8 * len(names))),
        (F.col("_phase") == F.col("_mix_phase"))
        & (F.col("_stream") == F.col("_mix_stream"))
        & (F.col("_nth") == F.col("_mix_nth")),
    )
    each = F.arrays_zip(
        _longs([rows[s] for s in names]).alias("rows"),
        _longs([share[s] * block_rows for s in names]).alias("per"),
        F.col("_mix_before").alias("before"),
    )

    def gone(x: Column) -> Column:
        earlier = F.least(x["rows"], x["per"] * F.col("_period"))
        now = F.least(x["rows"] - earlier, x["before"] * block_rows)
        return earlier + now

    place = F.aggregate(F.transform(each, gone), F.lit(0).cast("long"), lambda a, b: a + b)
    done = F.col("_block")
    return _with_places(
        joined,
        F.col("_stream").cast("long"),
        done,
        F.floor(done * total / part).cast("long"),
        F.ceil((done + 1) * total / part).cast("long"),
        F.col("_period") * total + F.col("_mix_slot"),
        place + F.col("_n") % block_rows,
        keep=docs.columns,
    )


_PLACES = ["mix_stream", "mix_block", "mix_release", "mix_due", "mix_slot", "mix_position"]


def _with_places(df: DataFrame, *values: Column, keep: list[str] | None = None) -> DataFrame:
    columns = [c for c in (keep or df.columns) if c not in _PLACES]
    return df.select(*columns, *[v.alias(n) for v, n in zip(values, _PLACES, strict=True)])


def own_weights(docs: DataFrame, weights: dict[str, float], most: int = PARTS, source: str = "source") -> dict[str, float]:
    """``weights`` with the share of ``"other"`` given out to the sources not named, by their
    rows: each of the ``most`` largest gets its own, the rest and null stay ``"other"``.  A
    pattern is worked out by streams times parts for every set of streams, so its time grows
    with their cube; a thousand is what it is meant for."""
    named = [s for s in weights if s != OTHER]
    spare = weights.get(OTHER, 0.0)
    unnamed = docs.where(F.col(source).isNull() | ~F.col(source).isin(named)) if named else docs
    counts = unnamed.groupBy(F.col(source).alias("s")).count()
    all_rows = counts.agg(F.sum("count")).first()[0]
    if not spare or not all_rows:
        return dict(weights)
    largest = counts.where(F.col("s").isNotNull() & (F.col("s") != OTHER)).orderBy(F.desc("count"), "s").limit(most).collect()
    own = {r["s"]: spare * r["count"] / all_rows for r in largest}
    rest = all_rows - sum(r["count"] for r in largest)
    return {**{s: weights[s] for s in named}, **own, **({OTHER: spare * rest / all_rows} if rest else {})}


def in_mixed_order(
    docs: DataFrame, weights: dict[str, float], block_rows: int = BLOCK_ROWS, places: bool = False
) -> DataFrame:
    """``docs`` with the same rows and columns, laid out in the order of the mix: partitions
    follow each other by position, and rows within them.  With ``places`` the columns of
    ``mixed`` are kept."""
    placed = mixed(docs, weights, block_rows)
    rows = placed.agg(F.max("mix_position")).first()[0]
    if rows is None:
        return placed if places else docs
    n = partitions(docs.sparkSession)
    part = F.floor(F.col("mix_position") * n / (rows + 1)).cast("int")
    ordered = placed.repartitionById(n, part).sortWithinPartitions("mix_position")
    return ordered if places else ordered.select(*docs.columns)


def with_read_position(docs: DataFrame, name: str = "mix_position") -> DataFrame:
    """``docs``, a frame just read from files that one write made, with the gapless place of
    every row in them, however a scan orders and packs the files: rows of earlier files and of
    earlier lines of its own.  Files go by their number, then by path."""
    path, line = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    placed = docs.select(*docs.columns, path.alias("_file"), line.alias("_line"))
    number = F.regexp_extract("_of", r"part-(\d+)[^/]*$", 1).try_cast("long")
    before = Window.orderBy(number, "_of").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    sizes = docs.groupBy(path.alias("_of")).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.select("_of", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    files = docs.inputFiles()
    known = sum(map(len, files)) + 64 * len(files)
    joined = placed.join(_small(sizes, known), F.col("_file") == F.col("_of"))
    kept = [c for c in docs.columns if c != name]
    return joined.select(*kept, (F.col("_before") + F.col("_line")).cast("long").alias(name))
