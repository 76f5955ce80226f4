"""Daily increments as a stream: new files are read once, and the newest revision of each entity is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.functions.days import parse_timestamp
from entilake.sources.dump import _END, _pages, revisions_of


def stream_revisions(spark: SparkSession, folder: str, files_per_batch: int = 16) -> DataFrame:
    """Revisions of the dump files that come into `folder` (any depth), as a stream. A text line is a page, so compressed
    files are split among tasks."""
    reader = spark.readStream.option("lineSep", _END).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
    return revisions_of(_pages(reader.text(folder)))


def _newest(rows: DataFrame) -> DataFrame:
    rest = [c for c in rows.columns if c not in ("entity", "rev_id")]
    return rows.where(F.col("content") != "").groupBy("entity").agg(F.max(F.struct("rev_id", *rest)).alias("_b")).select("entity", "_b.*")


def ingest_available(spark: SparkSession, folder: str, store: str, checkpoint: str, files_per_batch: int = 16) -> None:
    """Reads all files of `folder` that no earlier call with this checkpoint has read, and ends. Each batch writes the newest
    revision of its entities into a folder named by the batch, overwriting what a failed attempt left there: nothing is
    lost and nothing counts twice, whenever the job is stopped."""

    def save(batch: DataFrame, batch_id: int) -> None:
        _newest(batch).write.mode("overwrite").parquet(f"{store}/batch={batch_id}")

    query = stream_revisions(spark, folder, files_per_batch).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _folders(spark: SparkSession, store: str) -> tuple[list[str], list[str]]:
    """Complete folders of the store: batches and compacted states, oldest first. A state covers all batches up to its own
    number, so of these only the newest state and later batches count."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(store).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getParent().getName() for f in fs.globStatus(path(f"{store}/*=*/_SUCCESS")) or []]
    kind = lambda k: sorted((n for n in names if n.startswith(f"{k}=")), key=lambda n: int(n.split("=")[1]))
    return kind("batch"), kind("state")


def latest_state(spark: SparkSession, store: str) -> DataFrame:
    """Newest revision of each entity over all batches. Revisions are compared by number, so the order in which the files
    came does not matter, nor do late ones. Batches that a compacted state covers are not read."""
    batches, states = _folders(spark, store)
    last = int(states[-1].split("=")[1]) if states else -1
    live = states[-1:] + [b for b in batches if int(b.split("=")[1]) > last]
    parts = [spark.read.parquet(f"{store}/{name}") for name in live]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _newest(out)


def compact(spark: SparkSession, store: str) -> None:
    """Write the state over all batches so far as one folder, and remove the batches and states it covers. Not while a batch
    is being written; a compaction that fails leaves the store as it was."""
    batches, states = _folders(spark, store)
    if not batches:
        return
    number = max(int(n.split("=")[1]) for n in batches + states)
    latest_state(spark, store).write.mode("overwrite").parquet(f"{store}/_compacting")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(store).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if f"state={number}" in states:
        fs.delete(path(f"{store}/state={number}"), True)
    fs.rename(path(f"{store}/_compacting"), path(f"{store}/state={number}"))
    for name in batches + [s for s in states if s != f"state={number}"]:
        fs.delete(path(f"{store}/{name}"), True)


def stream_edits_per_day(revisions: DataFrame, delay: str = "14 days") -> DataFrame:
    """Counts per day of a stream of revisions, each revision once, with days closed `delay` after the newest time stamp.
    Revisions with a time stamp that is none are left out."""
    stamped = revisions.withColumn("at", parse_timestamp(F.col("ts")).cast("timestamp")).where("at is not null").withWatermark("at", delay)
    once = stamped.dropDuplicatesWithinWatermark(["rev_id"])
    return once.groupBy(F.window("at", "1 day").alias("w")).agg(F.count("*").alias("edits"), F.count_if("is_ip").alias("anons")).select(F.to_date("w.start").alias("day"), "edits", "anons")
