"""Percentiles of durations from logarithmic buckets.

Octaves of four equal parts, 192 buckets in all; inside a bucket the estimate is linear, and never
above the exact maximum. Buckets of partial results add up, so the samples are aggregated before any
shuffle and a series of any length is 192 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PARTS = 4
BUCKETS = 48 * PARTS


def bucket(value: Column) -> Column:
    """Bucket of a duration; negative ones count as 0."""
    v = F.greatest(value.cast("long"), F.lit(0))
    # the octave is the length of the binary form less one: exact, unlike a logarithm
    octave = F.length(F.bin(v)) - 1
    low = F.call_function("shiftleft", F.lit(1).cast("long"), octave)
    part = F.floor((v - low) * PARTS / low).cast("int")
    return F.when(v <= 1, 0).otherwise(F.least(octave * PARTS + part, F.lit(BUCKETS - 1))).cast("int")


def bounds(b: Column) -> tuple[Column, Column]:
    octave, part = F.floor(b / PARTS).cast("int"), b % PARTS
    low = F.call_function("shiftleft", F.lit(1).cast("long"), octave)
    step = F.floor(low / PARTS).cast("long")
    start = F.when(b == 0, F.lit(0)).when(step == 0, low).otherwise(low + part * step).cast("long")
    width = F.when(b == 0, F.lit(2)).when(step == 0, F.lit(1)).otherwise(step).cast("long")
    return start, start + width


def histogram(samples: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    v = F.greatest(F.col(value).cast("long"), F.lit(0))
    return samples.groupBy(*keys, bucket(F.col(value)).alias("bucket")).agg(F.count("*").alias("n"), F.sum(v).alias("total"), F.max(v).alias("max"), F.count_if(v > 0).alias("non_zero"))


def percentiles(samples: DataFrame, keys: list[str], value: str = "value", fractions: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """count, total, max, non_zero and p<percent> of every series. No samples, no row."""
    h = histogram(samples, keys, value)
    w = Window.partitionBy(*keys)
    h = h.withColumn("count", F.sum("n").over(w)).withColumn("top", F.max("max").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("bucket")))
    low, high = bounds(F.col("bucket"))
    out = [F.first("count").alias("sample_count"), F.sum("total").alias("total"), F.first("top").alias("max"), F.sum("non_zero").alias("non_zero")]
    for f in fractions:
        target = F.greatest(F.ceil(F.lit(f) * F.col("count")), F.lit(1))
        here = (F.col("upto") >= target) & (F.col("upto") - F.col("n") < target)
        within = (target - (F.col("upto") - F.col("n"))) / F.col("n").cast("double")
        at = F.least(low + F.floor((high - low) * within).cast("long"), F.col("top"))
        out.append(F.max(F.when(here, at)).alias(f"p{round(f * 100)}"))
    return h.groupBy(*keys).agg(*out)


def phase_shares(samples: DataFrame, run: str = "run_id", phase: str = "phase", value: str = "value", whole: str = "row_total") -> DataFrame:
    """Percentiles of every phase of a run in ms, and its share of the whole's total."""
    p = percentiles(samples, [run, phase], value)
    all_ = p.where(F.col(phase) == whole).select(run, F.col("total").alias("_whole"))
    ms = lambda c: (F.col(c) / 1000).cast("decimal(18,1)").alias(f"{c}_ms")
    share = (F.col("total") * 100 / F.nullif("_whole", F.lit(0))).cast("decimal(9,1)").alias("share_percent")
    return p.join(all_, run, "left").select(run, phase, "sample_count", *(ms(c) for c in ("total", "p50", "p95", "p99", "max")), share)


def verdict(rows: DataFrame) -> DataFrame:
    """What bounds each run: rows has run_id, row_total, write_backoff and write_in_flight totals."""
    whole = F.col("row_total")
    back = F.when(whole <= 0, 0).otherwise(F.col("write_backoff") * 100 / whole)
    flying = F.col("write_in_flight") / F.when(whole <= 0, F.lit(1)).otherwise(whole)
    return rows.withColumn("verdict", F.when(back >= 40, "throttle-bound").when(flying >= 0.5, "latency-bound").otherwise("neither"))
