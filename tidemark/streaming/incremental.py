"""Incremental inventory updates as a stream: an extension, not a window over event time.

New files of items arrive; each micro-batch is compared with the inventory and its changes are recorded.
The inventory lies in buckets by the hash of its keys. A batch reads and rewrites only the buckets that its
own items fall into, under its number, and then writes a manifest: of every bucket, the batch that wrote it
last. A batch that is run again starts from the manifest before it and writes the same files again, so
the result is exactly once; files that no manifest names are left by attempts that did not end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import inventory as inv

BUCKETS = 256
_MANIFEST = "bucket int, version long"


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest(spark: SparkSession, state: str, before: int | None = None) -> dict[int, int]:
    """Bucket to the batch that wrote it last, of the newest whole manifest (below a batch number)."""
    path, fs = _path(spark, f"{state}/manifest")
    if not fs.exists(path):
        return {}
    numbers = [int(s.getPath().getName()[2:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v=")]
    done = [n for n in numbers if (before is None or n < before) and fs.exists(_path(spark, f"{state}/manifest/v={n}/_SUCCESS")[0])]
    return {r["bucket"]: r["version"] for r in spark.read.schema(_MANIFEST).parquet(f"{state}/manifest/v={max(done)}").collect()} if done else {}


def _rows(spark: SparkSession, state: str, buckets: dict[int, int]) -> DataFrame:
    paths = [f"{state}/data/v={v}/bucket={b}" for b, v in sorted(buckets.items())]
    return spark.read.schema(_empty(spark).schema).parquet(*paths) if paths else _empty(spark)


def inventory_of(spark: SparkSession, state: str) -> DataFrame:
    """The inventory after the last batch that ended."""
    return _rows(spark, state, _manifest(spark, state))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.hash(*inv.KEY), F.lit(buckets)).cast("int")


def apply_batch(batch: DataFrame, number: int, state: str, as_of, buckets: int = BUCKETS) -> None:
    """Records one batch of items (see follow) in the state. The number of buckets must stay that of the first
    batch. The numbers of the touched buckets reach the driver, no more than there are buckets."""
    spark = batch.sparkSession
    before = _manifest(spark, state, number)
    rest = F.struct(*[c for c in batch.columns if c not in inv.KEY])
    latest = batch.groupBy(*inv.KEY).agg(F.max_by(rest, "run_id").alias("r")).select(*inv.KEY, "r.*")
    touched = {r[0] for r in batch.select(_bucket(buckets)).distinct().collect()}
    old = _rows(spark, state, {b: v for b, v in before.items() if b in touched})
    judged = inv.compare_and_see(old, latest)
    out = inv.record_written(old, judged.where("action = 'write'").drop("action"), number, as_of)
    out = inv.record_unchanged(out, judged.where("action = 'unchanged'"), number)
    out = out.withColumn("bucket", _bucket(buckets)).repartition("bucket")
    out.write.mode("overwrite").partitionBy("bucket").parquet(f"{state}/data/v={number}")
    after = spark.createDataFrame(sorted((before | dict.fromkeys(touched, number)).items()), _MANIFEST)
    after.coalesce(1).write.mode("overwrite").parquet(f"{state}/manifest/v={number}")


def follow(spark: SparkSession, incoming: str, schema: T.StructType, state: str, checkpoint: str, as_of, *, buckets: int = BUCKETS, files_per_batch: int = 1000) -> StreamingQuery:
    """Applies all files under incoming that were not applied yet, then ends (available now).

    schema: connection_id, item_id, item_type, content_hash, acl_hash, content_bytes, run_id.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)
    record = lambda batch, number: apply_batch(batch, number, state, as_of, buckets)
    return stream.writeStream.foreachBatch(record).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "connection_id string, item_id string, item_type string, content_hash string, acl_hash string, content_bytes long, first_seen_run long, last_seen_run long, last_written_run long, last_written_utc timestamp, state int, pending_since_utc timestamp, deleted_utc timestamp, unchanged_streak int")
