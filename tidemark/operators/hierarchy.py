"""Hierarchies of unknown depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.workspace import unused

ROOT, CHILD, ORPHAN, CYCLE = "root", "child", "orphan", "cycle"


def ancestor_closure(units: DataFrame, code: str, parent: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """(ancestors, standing) of ``units``, which refer to themselves by ``parent``.

    ``ancestors`` has (code, ancestor, depth) for every unit and each unit above it, the
    parent at depth 1.  ``standing`` has (code, standing): a ``root`` has no parent, an
    ``orphan`` one that is no unit, a ``cycle`` leads into a circle of parents, the others
    are a ``child``.  Units that lead into a circle have no ancestors.  Units without a code
    are left out; of several rows of one code the smallest parent counts.

    Pointers are doubled: a round joins what lies up to n steps above a unit with the unit
    n steps above, so depth d takes log2(d) rounds.  A unit n steps deep has an ancestor
    fewer steps deep, so if as many units have a pointer after doubling as before, they all
    lead into a circle.  Each round is written to a sub-folder of ``folder``, which ends its
    lineage.
    """
    def kept(df: DataFrame, name: str) -> DataFrame:
        path = unused(folder, name)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    one = units.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("code")).agg(F.min(parent).alias("parent"))
    known = one.select(F.col("code").alias("parent"), F.lit(True).alias("exists"))
    placed = kept(one.join(known, "parent", "left").select("code", "parent", F.coalesce("exists", F.lit(False)).alias("exists")), "units")
    steps = placed.where("exists").select("code", F.col("parent").alias("up"))
    above = steps.select("code", F.col("up").alias("ancestor"), F.lit(1).alias("depth"))
    n, left = 1, steps.count()
    while left:
        jump = steps.withColumnRenamed("up", "via")
        higher = above.select(F.col("code").alias("via"), "ancestor", (F.col("depth") + n).alias("depth"))
        above = kept(above.unionByName(jump.join(higher, "via").select("code", "ancestor", "depth")), "ancestors")
        steps = kept(jump.join(steps.withColumnRenamed("code", "via"), "via").select("code", "up"), "pointers")
        n, before, left = 2 * n, left, steps.count()
        if left == before:
            break
    circular = steps.select("code").withColumn("circular", F.lit(True))
    standing = placed.join(circular, "code", "left").select(
        "code",
        F.when(F.col("circular"), CYCLE)
        .when(F.col("exists"), CHILD)
        .when(F.col("parent").isNull(), ROOT)
        .otherwise(ORPHAN)
        .alias("standing"),
    )
    return above.join(circular, "code", "left_anti"), standing
