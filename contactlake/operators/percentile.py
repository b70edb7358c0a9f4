"""Exact PERCENTILE_CONT per group that never gathers a whole group in one task.

The built-in ``percentile`` keeps every distinct value of a group in one aggregation
buffer, so a group holding a third of the rows would land in one task. Instead the wanted
rank of every group is narrowed down at once:

1. collapse duplicates: ``(group, value) -> count`` (partial aggregation map-side). This is
   the only read of the rows; the later steps reuse its shuffle;
2. cut the range of values that holds a group's rank into bins, count the bins (one small
   aggregate for all groups), and keep the bin that holds the rank; repeat;
3. rank the distinct values that are left, and interpolate linearly.

Everything is one lazy plan without a job of its own. A bin's range is that of its own
values, so each step divides a group's range by ``BINS`` at least.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: bins of a group in one step, and steps: a range of a thousand million is down to one value
BINS, STEPS = 1024, 3


def _on(left: DataFrame, right: DataFrame, cols: list[str]):
    """Null-safe equality of the group columns (named ``_s_<column>`` on the right)."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_s_{c}"]) for c in cols])


def _keyed(small: DataFrame, cols: list[str]) -> DataFrame:
    return small.select(*[F.col(c).alias(f"_s_{c}") for c in cols],
                        *[c for c in small.columns if c not in cols])


def value_counts(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """``(group, _v, _c)``: the distinct values of each group with their counts."""
    return df.where(F.col(value_col).isNotNull()).groupBy(*group_cols, F.col(value_col).alias("_v")) \
        .agg(F.count(F.lit(1)).alias("_c"))


def grouped_percentile_cont(df: DataFrame, group_cols: list[str], value_col: str,
                            p: float, out_col: str = "percentile") -> DataFrame:
    return percentile_of_counts(value_counts(df, group_cols, value_col), group_cols, p, out_col)


def percentile_of_counts(rows: DataFrame, group_cols: list[str], p: float, out_col: str) -> DataFrame:
    """The percentile of every group of ``value_counts``."""
    g = list(group_cols)
    # per group: the wanted rank (lower one, and the fraction towards the next) within the
    # values of [_lo, _hi]
    position = F.lit(1.0) + (F.sum("_c") - 1) * F.lit(float(p))
    narrowed = rows.groupBy(*g).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                                    F.floor(position).alias("_rank"), (position - F.floor(position)).alias("_frac"))
    for _ in range(STEPS):
        s = _keyed(narrowed, g)
        width = (F.col("_hi").cast("double") - F.col("_lo").cast("double")) / BINS
        place = F.when(width > 0, F.floor((F.col("_v").cast("double") - F.col("_lo").cast("double")) / width)).otherwise(0)
        bins = rows.join(s, _on(rows, s, g)).where(F.col("_v").between(F.col("_lo"), F.col("_hi"))) \
            .groupBy(*g, F.least(place, F.lit(BINS - 1)).alias("_bin"), "_rank", "_frac") \
            .agg(F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.sum("_c").over(Window.partitionBy(*g).orderBy("_bin")) - F.col("_c")   # at most BINS rows a group
        narrowed = bins.withColumn("_before", before) \
            .where((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_c"))) \
            .select(*g, "_lo", "_hi", (F.col("_rank") - F.col("_before")).alias("_rank"), "_frac")
    s = _keyed(narrowed, g)
    left = rows.join(s, _on(rows, s, g)).where(F.col("_v") >= F.col("_lo"))
    within = F.col("_v") <= F.col("_hi")
    up_to = F.sum("_c").over(Window.partitionBy(*g).orderBy("_v"))
    ranked = left.where(within).withColumn("_up_to", up_to) \
        .where(F.col("_up_to") >= F.col("_rank"))                        # the value at the rank, and later ones
    at = ranked.groupBy(*g).agg(F.min("_v").alias("_at"), F.min_by("_up_to", "_v").alias("_up_to"),
                                F.first("_rank").alias("_rank"), F.first("_frac").alias("_frac"))
    a = _keyed(at, g)
    # the next value counts only where the rank is the last one of its value
    after = rows.where(F.col("_c") > 0).join(a, _on(rows, a, g)).groupBy(*g).agg(
        F.min(F.when(F.col("_v") > F.col("_at"), F.col("_v"))).alias("_next"), F.first("_at").alias("_at"),
        F.first("_up_to").alias("_up_to"), F.first("_rank").alias("_rank"), F.first("_frac").alias("_frac"))
    low = F.col("_at").cast("double")
    high = F.when(F.col("_up_to") > F.col("_rank"), low).otherwise(F.coalesce(F.col("_next").cast("double"), low))
    return after.select(*g, (low + (high - low) * F.col("_frac")).alias(out_col))
