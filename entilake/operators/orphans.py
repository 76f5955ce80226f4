"""References to records that do not exist (problem 6).

A key is a kind of record and a number. Numbers are cut into ranges of 2^RANGE_BITS. Parents and references of a range meet in one sorted stream, parents first;
the parents of the range at hand are kept as a sorted array, and each batch of references is probed by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE_BITS = 12
#: A range is split when it has more references than all references divided by this, so at most so many are split.
MOST_SPLIT = 256


def find_orphans(references: DataFrame, parents: DataFrame, kind: str, number: str) -> DataFrame:
    """The rows of `references` whose key (`kind` STRING, `number` BIGINT) is no key of `parents`. Any BIGINT is a number.
    References without a kind or number refer to nothing and are left out; repeated references stay repeated, repeated and
    NULL parents change nothing. With no parents every reference is an orphan. Columns of `references` may have any names
    but those that begin with two underscores.

    One shuffle brings references and parents together by kind and range. Ranges with many references, as of an entity that
    a third of all records name, are counted beforehand and split by a hash of the row; only their parents, at most
    MOST_SPLIT ranges of 2^RANGE_BITS keys, are repeated. No group is collected: a task holds one range's parents."""
    columns = references.columns
    known = lambda df: df.where(F.col(kind).isNotNull() & F.col(number).isNotNull())
    placed = lambda df, *more: df.select(F.col(kind).alias("__kind"), F.col(number).cast("bigint").alias("__key"), *more).withColumn("__range", F.shiftright("__key", RANGE_BITS))
    refs = placed(known(references), *columns)
    by_range = refs.groupBy("__kind", "__range").agg(F.count("*").alias("__n"))
    total = by_range.agg(F.sum("__n")).first()[0] or 0
    limit = max(100_000, -(-total // MOST_SPLIT))
    hot = by_range.where(F.col("__n") > limit).select("__kind", "__range", F.ceil(F.col("__n") / limit).cast("int").alias("__splits"))
    hot = F.broadcast(hot.limit(MOST_SPLIT))  # the bound, stated for the optimizer: no more ranges can exceed the limit
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.coalesce("__splits", F.lit(1)))
    at = ["__kind", "__range"]
    refs = refs.join(hot, at, "left").select(*at, salt.cast("int").alias("__salt"), F.lit(1).alias("__tag"), "__key", *columns)
    held = placed(known(parents)).join(hot, at, "left")
    held = held.select(*at, F.explode(F.sequence(F.lit(0), F.coalesce("__splits", F.lit(1)) - 1)).alias("__salt"), F.lit(0).alias("__tag"), "__key")
    both = refs.unionByName(held, allowMissingColumns=True)
    sorted_ = both.repartition(*at, "__salt").sortWithinPartitions(*at, "__tag").select(*at, "__tag", "__key", *columns)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_of, known = None, np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds, ranges, tags, keys = (batch.column(i) for i in range(4))
            ranges, tags, keys = (c.to_numpy() for c in (ranges, tags, keys))
            codes = kinds.dictionary_encode()
            names, codes = codes.dictionary.to_pylist(), codes.indices.to_numpy()
            hit = np.zeros(len(keys), dtype=bool)
            # A batch holds few kinds and is sorted by them: one probe per kind, against the array of its ranges at hand.
            for code in dict.fromkeys(codes.tolist()):
                rows = np.flatnonzero(codes == code)
                if held_of is None or held_of[0] != names[code] or held_of[1] != ranges[rows[0]]:
                    known = np.empty(0, np.int64)
                known = np.unique(np.concatenate([known, keys[rows[tags[rows] == 0]]]))
                place = np.searchsorted(known, keys[rows])
                inside = place < len(known)
                hit[rows[inside]] = known[place[inside]] == keys[rows[inside]]
                held_of = (names[code], ranges[rows[-1]])
                known = known[known >> RANGE_BITS == held_of[1]]
            missing = batch.filter(pa.array((tags == 1) & ~hit))
            if missing.num_rows:
                yield pa.RecordBatch.from_arrays(missing.columns[4:], names=columns)

    return sorted_.mapInArrow(probe, references.select(columns).schema)
