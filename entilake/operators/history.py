"""History of changing attributes: type-two dimensions from snapshots (problem 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entilake.session import cut


def attribute_hash(attributes: list[str]) -> Column:
    """Hash of the attributes of a row. Each comes with a flag, because a hash passes over NULLs: without it (NULL, 5) and
    (5, NULL) would be equal."""
    return F.xxhash64(*[x for a in attributes for x in (F.col(a).isNull(), F.col(a))])


#: Columns that observations and versions have besides key, day and attributes.
RANK, HASH = "obs_rank", "attr_hash"


def _counting(df: DataFrame, key: str, day: str, rank: str, attributes: list[str]) -> DataFrame:
    """key, day, obs_rank, attributes, attr_hash: of the rows of one key and day the one with the highest rank (NULL is the
    lowest), ties by the greatest attributes.

    The maximum combines before the shuffle, so repeats of a hot key cost one row per task and day. One attribute of at most
    32 bits is packed with its rank into one number, whose maximum is kept in a hash table; a maximum over a struct would
    sort the rows of each task first."""
    kinds = {f.name: f.dataType for f in df.schema}
    small = all(isinstance(kinds[c], (T.ByteType, T.ShortType, T.IntegerType)) for c in (rank, *attributes))
    if small and len(attributes) == 1:
        (a,) = attributes
        lowest, half = -(1 << 31), 1 << 31
        one = F.shiftleft(F.coalesce(F.col(rank).cast("bigint"), F.lit(lowest).cast("bigint")), 32) + F.col(a).cast("bigint") + F.lit(half)
        best = df.groupBy(key, day).agg(F.max(one).alias("_best"))
        back = F.nullif(F.shiftright("_best", 32), F.lit(lowest).cast("bigint")).cast(kinds[rank])
        value = (F.col("_best").bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(half)).cast(kinds[a])
        out = best.select(key, day, back.alias(RANK), value.alias(a))
    else:
        best = F.max(F.struct(F.col(rank).alias(RANK), *attributes)).alias("_best")
        out = df.groupBy(key, day).agg(best).select(key, day, f"_best.{RANK}", *[f"_best.{a}" for a in attributes])
    return out.withColumn(HASH, attribute_hash(attributes))


def observations(df: DataFrame, key: str, day: str, rank: str, attributes: list[str]) -> DataFrame:
    """What counts of a snapshot table: one row (key, day, obs_rank, attributes, attr_hash) per key and day, see _counting.
    Rows without key or day, and rows in which every attribute is NULL, say nothing and are left out; an empty table gives
    an empty one. A key has at most one row per calendar day."""
    known = df.where(F.col(key).isNotNull() & F.col(day).isNotNull() & F.coalesce(*[F.col(a).cast("string") for a in attributes]).isNotNull())
    return _counting(known, key, day, rank, attributes)


def seen_after(seen: DataFrame, updates: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """The observations merged so far, after `updates` were merged too."""
    return _counting(seen.unionByName(updates), key, day, RANK, attributes)


def versions(obs: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """Versions from observations: key, attributes, attr_hash, from_day, last_day (last day with an observation of it), to_day
    (NULL: open), is_current. A version starts where the hash differs from that of the observation before, and ends on the
    day before the next starts."""
    w = W.partitionBy(key).orderBy(day)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    steps = obs.withColumn("_before", F.lag(HASH).over(w)).withColumn("_day_before", F.lag(day).over(w)).withColumn("_end", F.max(day).over(whole))
    starts = steps.where(F.col("_before").isNull() | (F.col("_before") != F.col(HASH)))
    ended = starts.withColumn("to_day", F.lead(day).over(w) - 1).withColumn("last_day", F.coalesce(F.lead("_day_before").over(w), "_end"))
    return ended.select(key, *attributes, HASH, F.col(day).alias("from_day"), "last_day", "to_day", F.col("to_day").isNull().alias("is_current"))


def merge_versions(dimension: DataFrame | None, seen: DataFrame | None, updates: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """Type-two merge of a batch of observations into a dimension (columns of `versions`).

    The open version of each key stands for the observations before the batch: equal hashes leave it open, another hash
    closes it on the day before and inserts a new open version; new keys are inserted. A batch may hold many days of a key.
    Keys with a late observation (not after the last day of their open version) are rebuilt from `seen`, the observations
    merged so far: a late row can split or replace closed versions, and also the open one, whose confirming days are in
    `seen` only. All other rows of the dimension are passed on as they are, and `seen` is read for late keys only.

    dimension and seen: None for the first load, both needed after it. Of observations of one key and day, in `seen` or in
    the batch, the highest rank counts. Result: the new dimension, one row per version, gap-free and without overlap per key
    between its first day and now."""
    if dimension is None:
        return versions(updates, key, day, attributes)
    if seen is None:
        raise ValueError("a merge into a dimension needs the observations merged so far")
    first = updates.groupBy(key).agg(F.min(day).alias("_first"))
    late = F.coalesce(F.col("_first") <= F.col("last_day"), F.lit(False)).alias("_late")
    touched = cut(first.join(dimension.where("is_current").select(key, "last_day"), key, "left").select(key, late))
    flagged = dimension.join(touched, key, "left")
    kept = flagged.where("_late is null or (not _late and not is_current)").drop("_late")
    # An open version comes back as what was seen of it: its first and its last day.
    days = F.explode(F.array_distinct(F.array("from_day", "last_day")))
    rank = F.lit(None).cast(updates.schema[RANK].dataType)
    opened = flagged.where("not _late and is_current").select(key, days.alias(day), rank.alias(RANK), *attributes, HASH)
    again = seen.join(touched.where("_late"), key, "left_semi")
    pool = opened.unionByName(updates).unionByName(again).repartition(key)  # one shuffle for both steps below
    return kept.unionByName(versions(_counting(pool, key, day, RANK, attributes), key, day, attributes))
