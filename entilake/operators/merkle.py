"""Incremental processing by Merkle trees over key ranges (problem 3).

A state is one row (key, version) per record. Its tree is a table (level, node, n, digest): on level 0 a node is a range of
2^LEAF_BITS keys with the digest of its records, on each level above a range of 2^FAN_BITS nodes with the digest of the leaves
below. Digests are sums of hashes, so a node's new digest is its old one plus the differences of its leaves, and siblings
need not be read. A run computes the nodes on the paths from the leaves its rows touch to the top, descends where they differ
from the saved ones, reads row by row only the leaves that differ, and publishes its output and the changed nodes together.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.session import cut

LEAF_BITS, FAN_BITS, LEVELS = 6, 6, 5
#: After so many runs that wrote changes only, a run writes the whole state and tree; the folders of so many published runs
#: are kept for readers of their output.
COMPACT_AFTER, KEEP_RUNS = 16, 8


def state(rows: DataFrame, key: str, version: str) -> DataFrame:
    """(key, version): the highest version of each key; rows without a key or version are left out. The maximum
    combines before the shuffle, so a key with a third of all rows is one row per task after it."""
    return rows.select(F.col(key).cast("bigint").alias("key"), F.col(version).cast("bigint").alias("version")).where("key is not null and version is not null").groupBy("key").agg(F.max("version").alias("version"))


def _leaf() -> Column:
    return F.shiftright("key", LEAF_BITS)


def _hash(*columns: str) -> Column:
    """A hash that sums of do not wrap."""
    return F.xxhash64(*columns).cast("decimal(20,0)")


def _sum(column: str | Column) -> Column:
    return F.sum(column).cast("decimal(38,0)")


def tree(records: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """(level, node, n, digest) of the leaves that `records` fill (all records of such a leaf) and of all nodes above them.
    saved: the tree of all records before, None for a first one. One grouping for the leaves, one for all levels above."""
    leaves = cut(records.groupBy(_leaf().alias("node")).agg(F.count("*").alias("n"), _sum(_hash("key", "version")).alias("digest")))
    steps = leaves.select("node", "n", _hash("node", "n", "digest").alias("_h"))
    if saved is not None:
        before = saved.where("level = 0").select("node", F.col("n").alias("_n"), _hash("node", "n", "digest").alias("_b"))
        zero = lambda c: F.coalesce(c, F.lit(0))
        steps = steps.join(before, "node", "left").select("node", (F.col("n") - zero("_n")).alias("n"), (F.col("_h") - zero("_b")).alias("_h"))
    each = steps.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(LEVELS - 1))))
    above = each.groupBy("level", F.expr(f"shiftright(node, {FAN_BITS} * level)").alias("node")).agg(F.sum("n").alias("n"), _sum("_h").alias("digest"))
    if saved is not None:
        old = saved.where("level > 0").select("level", "node", F.col("n").alias("_n"), F.col("digest").alias("_d"))
        above = above.join(old, ["level", "node"], "left").select("level", "node", (F.col("n") + zero("_n")).alias("n"), (F.col("digest") + zero("_d")).cast("decimal(38,0)").alias("digest"))
    return leaves.withColumn("level", F.lit(0)).select("level", "node", "n", "digest").unionByName(cut(above))


def _unlike(new: DataFrame, saved: DataFrame) -> DataFrame:
    """Nodes of `new` that are not as saved."""
    there = saved.select("level", "node", F.col("n").alias("_n"), F.col("digest").alias("_d"))
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("digest").eqNullSafe(F.col("_d"))
    return new.join(there, ["level", "node"], "left").where(~same).select("level", "node", "n", "digest")


def differing_leaves(new: DataFrame, saved: DataFrame) -> DataFrame:
    """Leaves (node) of the tree `new` that are not as in `saved`. The descent starts at the top and looks only at the
    children of nodes that differ."""
    found = None
    for level in reversed(range(LEVELS)):
        at = lambda df: df.where(F.col("level") == level)  # noqa: B023, E731
        here = at(new)
        if found is not None:
            here = here.join(found.select(F.col("node").alias("_up")), F.shiftright("node", FAN_BITS) == F.col("_up"), "left_semi")
        found = _unlike(here, at(saved)).select("node")
    return found


def changes(current: DataFrame, saved: DataFrame, leaves: DataFrame) -> DataFrame:
    """(key, version) of the records in differing leaves whose version is above the saved one, or that have none."""
    leaves = leaves.select(F.col("node").alias("_leaf"))
    inside = lambda df: df.join(leaves, _leaf() == F.col("_leaf"), "left_semi")
    old = inside(saved).withColumnRenamed("version", "_saved")
    return inside(current).join(old, "key", "left").where(F.col("_saved").isNull() | (F.col("version") > F.col("_saved"))).select("key", "version")


class IncrementalStore:
    """Runs in a folder on shared storage. A run writes its output and the tree nodes it changed into a folder of its own
    and then publishes them together by creating one small file, named by the number of the run: of two runs that started
    from the same state only one can, the other fails. A run that fails before leaves nothing behind that a later one reads,
    and the next starts from the last published state: nothing is skipped, nothing is repeated. Needs a file system in
    which a file can be created only once, as HDFS; on an object store without such a call let a scheduler run one at a time.

    Published runs hold changes only; every COMPACT_AFTER runs the whole state and tree are written, and folders of failed
    and of old runs are removed."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.root}/{folder}")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(n for n in names if not n.startswith((".", "_")))

    def published(self) -> list[str]:
        """Numbers of published runs, oldest first."""
        return self._names("published")

    def _manifest(self, number: str) -> dict:
        """base: folder with a whole state and tree; runs: folders with changes since, oldest first."""
        text = self.spark.read.text(f"{self.root}/published/{number}", wholetext=True).first()
        return json.loads(text[0])

    def _folder(self, run: str, what: str) -> str:
        return f"{self.root}/runs/{run}/{what}"

    def saved(self) -> tuple[DataFrame, DataFrame, dict]:
        """State and tree of the last published run, and its manifest."""
        manifest = self._manifest(self.published()[-1])
        read = self.spark.read
        records, nodes = read.parquet(self._folder(manifest["base"], "state")), read.parquet(self._folder(manifest["base"], "tree"))
        if manifest["runs"]:
            outputs = read.parquet(*[self._folder(r, "output") for r in manifest["runs"]])
            records = records.unionByName(outputs).groupBy("key").agg(F.max("version").alias("version"))
            aged = nodes.withColumn("_age", F.lit(0))
            for age, r in enumerate(manifest["runs"], 1):
                aged = aged.unionByName(read.parquet(self._folder(r, "changed")).withColumn("_age", F.lit(age)))
            newest = aged.groupBy("level", "node").agg(F.max(F.struct("_age", "n", "digest")).alias("_b"))
            nodes = cut(newest.select("level", "node", "_b.n", "_b.digest"))
        return records, nodes, manifest

    def run(self, rows: DataFrame, key: str, version: str) -> DataFrame:
        """Process what is new in `rows` (all rows, or those delivered since; old and repeated ones change nothing) and
        publish. Returns the run's output: (key, version) of added and changed records."""
        numbers = self.published()
        number = int(numbers[-1]) + 1 if numbers else 1
        run = f"{number:010d}-{uuid.uuid4().hex}"
        incoming = cut(state(rows, key, version))
        if not numbers:
            incoming.write.parquet(self._folder(run, "state"))
            tree(incoming).write.parquet(self._folder(run, "tree"))
            self._publish(number, {"base": run, "runs": [], "run": run})
            return self.spark.read.parquet(self._folder(run, "state"))
        old, old_tree, manifest = self.saved()
        touched = incoming.select(_leaf().alias("_leaf")).distinct()
        near = old.join(touched, _leaf() == F.col("_leaf"), "left_semi")
        current = cut(incoming.unionByName(near).groupBy("key").agg(F.max("version").alias("version")))
        nodes = tree(current, old_tree)
        changes(current, old, cut(differing_leaves(nodes, old_tree))).write.parquet(self._folder(run, "output"))
        _unlike(nodes, old_tree).write.parquet(self._folder(run, "changed"))
        out = self.spark.read.parquet(self._folder(run, "output"))
        if len(manifest["runs"]) + 1 >= COMPACT_AFTER:
            new = self.spark.read.parquet(self._folder(run, "changed"))
            old.unionByName(out).groupBy("key").agg(F.max("version").alias("version")).write.parquet(self._folder(run, "state"))
            old_tree.join(new, ["level", "node"], "left_anti").unionByName(new).write.parquet(self._folder(run, "tree"))
            manifest = {"base": run, "runs": []}
        else:
            manifest = {"base": manifest["base"], "runs": [*manifest["runs"], run]}
        self._publish(number, manifest | {"run": run})
        self._clean(number)
        return out

    def _publish(self, number: int, manifest: dict) -> None:
        """create() without overwrite fails where the number is taken: one publication per number."""
        stream = self._fs.create(self._path(f"{self.root}/published/{number:010d}"), False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()

    def _clean(self, number: int) -> None:
        """Remove the folders up to this number that none of the last KEEP_RUNS published runs needs."""
        kept: set[str] = set()
        for n in self.published()[-KEEP_RUNS:]:
            manifest = self._manifest(n)
            kept |= {manifest["base"], manifest["run"], *manifest["runs"]}
        for folder in self._names("runs"):
            if folder not in kept and int(folder.split("-", 1)[0]) <= number:
                self._fs.delete(self._path(f"{self.root}/runs/{folder}"), True)
