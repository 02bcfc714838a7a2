"""Exact order statistics without gathering a group into one task.

``percentile`` and ``row_number() OVER (PARTITION BY label ...)`` both move a
whole group through one task; with two labels that is half the table. Here
ranks come from counts of pieces:

* quantiles: the distinct values are dealt by range, the rows of every range
  partition are counted per group, and a prefix sum over these few counts tells
  which partition holds a wanted rank; ranks are exact inside that one,
* the k smallest hashes: leading bits of a uniform hash make the pieces.

The largest window any task sees is one piece of a group instead of all of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.operators.joins import broadcast_if_small, join_groups
from cardsentry.sources.storage import materialize, shared_root

DEFAULT_BUCKETS = 256
# Distinct values that one range partition (the largest window a task sorts)
# should hold at most, and the most partitions.
BUCKET_TARGET_VALUES = 1 << 18
MAX_BUCKETS = 1 << 16


def auto_buckets(widest: int, minimum: int = DEFAULT_BUCKETS) -> int:
    """Power-of-two number of pieces giving at most ~BUCKET_TARGET_VALUES values
    per piece of ``widest`` distinct values (clamped)."""
    need = max(1, -(-int(widest) // BUCKET_TARGET_VALUES))
    return max(minimum, min(MAX_BUCKETS, 1 << (need - 1).bit_length()))


def _keys(group_cols: Sequence[str]) -> list[str]:
    return list(group_cols) if group_cols else ["_all"]


def _with_key(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return df if group_cols else df.withColumn("_all", F.lit(0))


def exact_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    names: Sequence[str],
    buckets: int | None = None,
    with_summary: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles (``percentile`` / ``quantile_cont``).

    Returns one row per group with columns ``names[i]`` holding the
    ``probs[i]`` quantile of ``value_col`` (nulls ignored); ``with_summary``
    adds ``n``, ``min_value`` and ``max_value``. The input is read once.
    ``buckets`` sets the number of range partitions; without it there are as
    many as the session shuffles into, and more if these would be too wide.
    """
    g = _keys(group_cols)
    base = _with_key(df, group_cols).select(*g, F.col(value_col).cast("double").alias("_v"))
    # (1) distinct values with multiplicity: a hot value becomes one row per task
    counts = base.where(F.col("_v").isNotNull()).groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    counts = materialize(counts, "quantile-values")
    if buckets is None:
        need = auto_buckets(counts.count(), minimum=1)
        buckets = need if need > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None
    deal = [F.col(c) for c in (*g, "_v")]
    spread = counts.repartitionByRange(buckets, *deal) if buckets else counts.repartitionByRange(*deal)
    # the number of its partition stays with every row
    spread = materialize(spread.withColumn("_part", F.spark_partition_id()), "quantile-ranges")

    # (2) rows before every partition, per group: one short row per group and partition
    group = Window.partitionBy(*g)
    parts = spread.groupBy(*g, "_part").agg(
        F.sum("_c").alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    parts = parts.select(
        *g, "_part", "_rows", F.min("_lo").over(group).alias("min_value"), F.max("_hi").over(group).alias("max_value"),
        (F.sum("_rows").over(group.orderBy("_part")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(group).alias("n"),
    )
    # wanted 0-based ranks: floor and ceil of p * (n - 1) for every p
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    wanted = F.array_distinct(F.array(*[edge(x).cast("bigint") for x in place for edge in (F.floor, F.ceil)]))
    here = F.filter(wanted, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_rows")))
    targets = parts.select(*g, "_part", "_before", "n", "min_value", "max_value", here.alias("_ranks"))
    targets = targets.where(F.size("_ranks") > 0)

    # (3) exact ranks inside the targeted partitions only
    inside = join_groups(spread, targets, g + ["_part"])
    end = F.sum("_c").over(Window.partitionBy(*g, "_part").orderBy("_v")) + F.col("_before")
    hits = inside.withColumn("_end", end).select(
        *g, "n", "min_value", "max_value", "_v",
        F.explode(F.filter("_ranks", lambda r: (r >= F.col("_end") - F.col("_c")) & (r < F.col("_end")))).alias("_r"),
    )
    found = hits.groupBy(*g, "n", "min_value", "max_value").agg(
        F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at"))
    out = []
    for x, name in zip(place, names):
        lo, hi = (F.element_at("_at", edge(x).cast("bigint")) for edge in (F.floor, F.ceil))
        out.append((lo + (x - F.floor(x)) * (hi - lo)).alias(name))
    return found.select(*group_cols, *out, *(["n", "min_value", "max_value"] if with_summary else []))


def hash_rank_flag(
    df: DataFrame,
    group_cols: Sequence[str],
    hash_hex: Column,
    tie_col: str,
    k: Column,
    flag_name: str,
    bits: int = 20,
) -> DataFrame:
    """Flag the ``k`` rows per group with the smallest ``(hash_hex, tie_col)``.

    ``hash_hex`` must be a uniformly distributed hex text (e.g. ``md5``); its leading digits pick the bucket;
    a null group is a group like any other. The
    leading ``bits / 4`` hex digits of the hash give ``2**bits`` equally likely buckets.
    ``k`` is an expression over the group size column ``_n``.
    """
    g = _keys(group_cols)
    digits = bits // 4
    d = _with_key(df, group_cols).withColumn("_h", hash_hex).withColumn(
        "_bk", F.conv(F.substring("_h", 1, digits), 16, 10).cast("long")
    )
    per_bucket = d.groupBy(*g, "_bk").agg(F.count(F.lit(1)).alias("_bc"))
    per_bucket = per_bucket.withColumn(
        "_start", F.sum("_bc").over(Window.partitionBy(*g).orderBy("_bk")) - F.col("_bc")
    )
    sizes = per_bucket.groupBy(*g).agg(F.sum("_bc").alias("_n")).withColumn("_k", k.cast("long"))
    # the bucket that holds the k-th row (k >= 1), and how many of it to take
    cut = join_groups(per_bucket, sizes, g).where(
        (F.col("_k") > F.col("_start")) & (F.col("_k") <= F.col("_start") + F.col("_bc"))
    ).select(*g, F.col("_bk").alias("_cut_bk"), (F.col("_k") - F.col("_start")).alias("_take"))
    # groups with k = 0 take nothing: cut bucket -1
    limits = join_groups(sizes, cut, g, "left").select(
        *g, F.coalesce("_cut_bk", F.lit(-1)).alias("_cut_bk"), F.coalesce("_take", F.lit(0)).alias("_take")
    )
    # limits has one row per group, but computing it is a pass over the
    # input: write it once to the shared folder, so the size check and the
    # join read the small written table instead of aggregating the input twice
    shared_root(df.sparkSession)
    limits = limits.checkpoint(eager=True)
    d = join_groups(d, broadcast_if_small(limits), g)
    in_cut = d.where(F.col("_bk") == F.col("_cut_bk"))
    w = Window.partitionBy(*g, "_bk").orderBy("_h", tie_col)
    ranked_cut = in_cut.withColumn(flag_name, F.row_number().over(w) <= F.col("_take"))
    rest = d.where(F.col("_bk") != F.col("_cut_bk")).withColumn(
        flag_name, F.col("_bk") < F.col("_cut_bk")
    )
    out = ranked_cut.unionByName(rest).drop("_h", "_bk", "_cut_bk", "_take")
    return out if group_cols else out.drop("_all")


def dense_ids(rows: DataFrame, group_cols: Sequence[str], order: Sequence[Column], name: str = "id") -> DataFrame:
    """``rows`` with their 0-based number in the group by ``order``.

    Rows are dealt by range and sorted in their partitions; the rows of the
    partitions before give each partition its offset. No group has to fit into
    one task, and nothing is gathered on the driver.
    """
    by = [*[F.col(c) for c in group_cols], *order]
    spread = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    spread = materialize(spread, "dense-order").withColumn("_part", F.shiftright("_place", 33))
    runs = spread.groupBy(*group_cols, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group_cols).orderBy("_part")) - F.col("_n")
    runs = runs.select(*group_cols, "_part", (before - F.col("_first")).alias("_shift"))
    found = join_groups(spread, runs, [*group_cols, "_part"])
    return found.withColumn(name, F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")
