"""Exact medians by group that never gather one group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from regionlake.operators.sizing import salted_join, sized
from regionlake.session import durable

# Rank precision of the sketch and the half width of the bracket around the median.
SKETCH_ACCURACY = 10_000
BRACKET_HALF_WIDTH = 3.0 / SKETCH_ACCURACY
SLOTS = 1024
# Below half its accuracy the sketch drops nothing, whatever is merged with what, and its ranks are exact.
EXACT_ROWS = SKETCH_ACCURACY // 2 - 1


def group_medians(
    df: DataFrame,
    keys: list[str],
    medians: dict[str, str],
    extra: list[Column] | None = None,
    group_rows: int = EXACT_ROWS,
    salts: int = 32,
) -> DataFrame:
    """One row per key: exact medians (``{output: input column}``) and ``extra`` aggregates.

    One pass builds a mergeable quantile sketch per group, beside all other aggregates, and stores one row a group. Groups of up to
    ``group_rows`` (at most ``EXACT_ROWS``) values read their median from it. For larger groups the sketch brackets the median between two
    values, and one more pass over the rows counts what lies below the bracket and keeps the distinct values inside
    with their counts, shuffled by (group, value). The bracket is cut into slots, slot totals
    locate the slot of the middle ranks, and only that slot is ranked. Ranks are checked against the counts: a group
    whose bracket missed goes once more, between its least and largest value.

    Nulls and NaN are ignored, as in array libraries.
    """
    names, limit = list(medians), min(group_rows, EXACT_ROWS)
    # The ceiling of a rank share gives the lower middle value, and just above a half the upper one.
    middle = 0.5 + 0.5 / SKETCH_ACCURACY
    levels = [0.5 - BRACKET_HALF_WIDTH, 0.5, middle, 0.5 + BRACKET_HALF_WIDTH]
    sketches = []
    for o, c in medians.items():
        v = _clean(c)
        sketches += [F.count(v).alias(f"_n_{o}"), F.min(v).alias(f"_min_{o}"), F.max(v).alias(f"_max_{o}"),
                     F.percentile_approx(v, levels, SKETCH_ACCURACY).alias(f"_q_{o}")]
    stored = durable(df.groupBy(*keys).agg(*sketches, *(extra or [])))
    counts = [F.col(f"_n_{o}") for o in names]
    longest = F.greatest(*counts) if len(counts) > 1 else counts[0]
    rest = [c for c in stored.columns if c not in keys and not any(c == f"_{p}_{o}" for o in names for p in ("n", "min", "max", "q"))]
    direct = [((F.col(f"_q_{o}")[1] + F.col(f"_q_{o}")[2]) / 2.0).alias(o) for o in names]
    if (stored.agg(F.max(longest).alias("n")).first()["n"] or 0) <= limit:
        return stored.select(*keys, *direct, *rest)
    large = stored.where(longest > limit)
    narrow = [_bounds(o, limit, F.col(f"_q_{o}")[0], F.col(f"_q_{o}")[3]) for o in names]
    picked = durable(bracketed(df, large.select(*keys, *narrow), keys, medians, salts))
    missed = reduce(lambda a, b: a | b, [F.col(o).isNull() & (F.col(f"_n_{o}") > 0) for o in names])
    again = large.alias("l").join(picked.alias("r"), _same(keys), "left").where(missed).select(
        *_left(keys), *[F.col(f"l.{c}") for c in large.columns if c not in keys])
    if not again.isEmpty():
        wide = again.select(*keys, *[_bounds(o, limit, F.col(f"_min_{o}"), F.col(f"_max_{o}")) for o in names])
        others = picked.alias("l").join(again.alias("r"), _same(keys), "left_anti")
        picked = others.unionByName(bracketed(df, wide, keys, medians, salts))
    ranked = large.alias("l").join(picked.alias("r"), _same(keys), "left").select(
        *_left(keys), *[F.col(f"r.{o}") for o in names], *[F.col(f"l.{c}") for c in rest])
    return stored.where(longest <= limit).select(*keys, *direct, *rest).unionByName(ranked)


def _bounds(o: str, limit: int, lo: Column, hi: Column) -> Column:
    """Count and bracket of one column; a short one beside a long one takes all its values."""
    short = F.col(f"_n_{o}") <= limit
    return F.struct(F.col(f"_n_{o}").alias("n"), F.when(short, F.col(f"_min_{o}")).otherwise(lo).alias("lo"),
                    F.when(short, F.col(f"_max_{o}")).otherwise(hi).alias("hi")).alias(f"_b_{o}")


def bracketed(df: DataFrame, bounds: DataFrame, keys: list[str], medians: dict[str, str], salts: int) -> DataFrame:
    """The medians of the groups in ``bounds``, null where a bracket does not hold the middle ranks."""
    names = list(medians)
    stored = sized(bounds)
    edges = stored.df
    slim = df.select(*keys, *[_clean(c).alias(f"_v_{o}") for o, c in medians.items()])
    if stored.small:
        joined = slim.alias("l").join(F.broadcast(edges).alias("r"), _same(keys), "inner").select(
            *_left(keys), *[f"_v_{o}" for o in names], *[f"_b_{o}" for o in names]
        )
    else:
        # Null keys travel inside a struct, which an equi join compares null-safely.
        packed = F.struct(*keys).alias("_k")
        joined = salted_join(
            slim.select("*", packed), edges.select(packed, *[f"_b_{o}" for o in names]), ["_k"], salts
        ).drop("_k")
    long = joined.select(
        *keys,
        F.inline(
            F.array(*[
                F.struct(F.lit(i).alias("_i"), F.col(f"_v_{o}").alias("_v"), F.col(f"_b_{o}").alias("_b"))
                for i, o in enumerate(names)
            ])
        ),
    ).where(F.col("_v").isNotNull() & (F.col("_v") <= F.col("_b.hi")))
    # Values below the bracket count as one, without a value.
    counted = (
        long.withColumn("_v", F.when(F.col("_v") >= F.col("_b.lo"), F.col("_v")))
        .groupBy(*keys, "_i", "_b", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    share = F.coalesce(F.try_divide(F.col("_v") - F.col("_b.lo"), F.col("_b.hi") - F.col("_b.lo")), F.lit(0.0))
    slot = F.when(F.col("_v").isNull(), F.lit(0)).otherwise(
        F.lit(1) + F.floor(F.least(share, F.lit(1.0)) * F.lit(SLOTS)).cast("int")
    )
    slotted = counted.withColumn("_s", slot)
    # At most SLOTS + 2 rows per group reach this window.
    group = [*keys, "_i"]
    over_slots = Window.partitionBy(*group).orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)
    first_rank, last_rank = (F.col("_b.n") + 1).cast("bigint"), (F.col("_b.n") + 2).cast("bigint")
    low_rank = F.floor(first_rank / 2)
    high_rank = F.floor(last_rank / 2)
    targets = (
        slotted.groupBy(*group, "_b", "_s").agg(F.sum("_c").alias("_c"))
        .withColumn("_end", F.sum("_c").over(over_slots))
        .withColumn("_before", F.col("_end") - F.col("_c"))
        .where((F.col("_before") < high_rank) & (F.col("_end") >= low_rank))
        .select(*group, "_s", "_before")
    )
    in_slot = Window.partitionBy(*group, "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        slotted.alias("l").join(targets.alias("r"), _same([*group, "_s"]), "inner")
        .select(*_left([*group, "_s"]), "_b", "_v", "_c", "_before")
        .withColumn("_end", F.col("_before") + F.sum("_c").over(in_slot))
        .withColumn("_start", F.col("_end") - F.col("_c"))
    )
    holds = lambda rank: (F.col("_start") < rank) & (F.col("_end") >= rank)
    return ranked.groupBy(*keys).agg(
        *[
            (
                (
                    F.max(F.when((F.col("_i") == i) & holds(low_rank), F.col("_v")))
                    + F.max(F.when((F.col("_i") == i) & holds(high_rank), F.col("_v")))
                ) / 2.0
            ).alias(o)
            for i, o in enumerate(names)
        ]
    )


def _clean(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])


def _left(keys: list[str]) -> list[Column]:
    # No alias: an aliased key would make the two readers of the counted values differ,
    # and they could no longer share its shuffle.
    return [F.col(f"l.{k}") for k in keys]
