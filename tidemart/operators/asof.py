"""Each fact with the version of its key that held on its day, without pairs of facts and versions.

Facts and versions are put into one order (key, day, versions first) and dealt to ranges; the last version is carried
forward along the rows and, through a table with a row for each range, into the ranges that follow. So a key may have any
share of the facts and any number of versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemart.operators.ranges import ranged


def as_of(
    facts: DataFrame, versions: DataFrame, key: str, at: str, since: str, carried: list[str], until: str | None = None, tie: str | None = None
) -> DataFrame:
    """The facts with ``version``, a struct of the ``carried`` columns; null where no version has begun, or where the last
    to begin ended (``until``, inclusive) before.

    Both tables call the key by the same name. Of versions that begin on one day the last by ``tie`` holds; a null key
    meets no version. Repeated facts stay; an empty table of versions gives nulls.
    """
    kept = F.struct(*carried, *([F.col(until).alias("_until")] if until else []))
    f = facts.select(F.col(key).alias("_key"), F.col(at).alias("_day"), F.lit(1).alias("_kind"), F.struct("*").alias("_row"))
    v = versions.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(since).alias("_day"),
        F.lit(0).alias("_kind"),
        F.col(tie or since).cast("string").alias("_tie"),
        F.struct(F.col(key).alias("key"), kept.alias("version")).alias("_version"),
    )
    dealt = ranged(v.unionByName(f, allowMissingColumns=True), ["_key", "_day", "_kind", "_tie"])
    along = Window.partitionBy("_part").orderBy("_at")
    ends = dealt.groupBy("_part").agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_end"))
    # a row for each range: the last version of those before
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(F.col("_part").alias("_in"), F.last("_end", True).over(earlier).alias("_handed"))
    own = dealt.withColumn("_last", F.last("_version", True).over(along)).where("_kind = 1")
    met = own.join(F.broadcast(handed), F.col("_part") == F.col("_in"), "left").withColumn("_last", F.coalesce("_last", "_handed"))
    holds = F.col("_last.key") == F.col("_key")
    if until:
        holds &= F.coalesce(F.col("_day") <= F.col("_last.version._until"), F.lit(True))
    out = F.struct(*[F.col(f"_last.version.{c}").alias(c) for c in carried])
    return met.select("_row.*", F.when(holds, out).alias("version"))
