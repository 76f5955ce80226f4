"""Mixing sources to target weights (problem 8), by weighted fair queueing.

Each use of a document has a virtual finish time: the tokens of its source up to and with it, in shuffled order, divided
by the source's target share. All uses are ordered by it and cut at the budget. Cumulative sums are made of sums per part
of the order and running sums within the parts, so that neither a source nor the whole is one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Most sources with a target; more are refused. The targets are broadcast.
MAX_SOURCES = 10_000
#: Documents in a part of a source's order, on average over all, and the most parts (bits) an order has.
PART_ROWS, MOST_BITS = 50_000, 20
#: Parts of the time or hashes that are searched for the end of the budget.
TIME_PARTS = 1024
#: Uses that are summed row by row, in one task.
MOST_ROWS = 50_000


def clean_source(column: str) -> Column:
    """Source names compare without letter case and outer blanks."""
    return F.lower(F.btrim(column, F.lit(" \t\n\r\f\v")))


def targets_of(mix: DataFrame, source: str, share: str, repeats: str) -> DataFrame:
    """(source as written, _source, _share, _repeats) of the targets. Of targets whose names compare equal the first by
    name counts; rows without a name, and shares that are NULL or not positive, take no part. Shares of more than 1 together
    are scaled to 1."""
    rows = mix.where(F.col(source).isNotNull() & (F.col(share) > 0)).select(F.col(source).alias("source"), clean_source(source).alias("_source"), F.col(share).cast("double").alias("_share"), F.greatest(F.coalesce(F.col(repeats), F.lit(1)), F.lit(0)).cast("int").alias("_repeats"))
    if rows.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources have a target")
    one = rows.groupBy("_source").agg(F.min(F.struct("source", "_share", "_repeats")).alias("_t"))
    whole = F.greatest(F.lit(1.0), F.round(F.sum("_t._share").over(W.partitionBy(F.lit(0))), 9))  # MAX_SOURCES rows at most
    return one.select("_t.source", "_source", (F.col("_t._share") / whole).alias("_share"), "_t._repeats")


def virtual_end(sources: list[tuple[float, float]], budget: float) -> float:
    """The virtual time at which sources with (share, most tokens they can give) have given `budget` tokens together;
    infinite if they cannot. Sources run out in the order of tokens over share."""
    given, rate, now = 0.0, sum(w for w, _ in sources), 0.0
    for w, most in sorted(sources, key=lambda x: x[1] / x[0]):
        out = most / w
        if given + rate * (out - now) >= budget:
            return now + (budget - given) / rate
        given, now = given + rate * (out - now), out
        rate -= w
    return float("inf")


def finish_times(docs: DataFrame, targets: DataFrame, budget: int, seed: int = 7) -> DataFrame:
    """The uses a source may make: doc_id, source, replica, n_tokens, finish DOUBLE (virtual finish time).

    docs: doc_id, source, n_tokens. All documents of a source come once before any comes again; each pass is shuffled by
    a seeded hash. A source is repeated max_repeats times at most, and not past the virtual time at which all sources
    together have given the budget, which follows from their supplies; so there are no more uses than the budget needs
    and one more pass of each source."""
    own = docs.select("doc_id", clean_source("source").alias("_source"), F.col("n_tokens").cast("bigint").alias("n_tokens")).join(F.broadcast(targets), "_source")
    supply = own.groupBy("_source", "_share", "_repeats").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")).collect()  # MAX_SOURCES rows at most
    end = virtual_end([(r["_share"], float((r["n"] or 0) * r["_repeats"])) for r in supply], float(budget))
    needed = lambda r: r["_repeats"] if math.isinf(end) else min(r["_repeats"], math.ceil(end * r["_share"] / max(r["n"] or 0, 1)) + 1)
    passes = docs.sparkSession.createDataFrame([(r["_source"], needed(r)) for r in supply], "_source string, _passes int")
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, sum(r["rows"] for r in supply) / PART_ROWS)))))
    uses = own.join(F.broadcast(passes), "_source").where("_passes > 0").withColumn("replica", F.explode(F.sequence(F.lit(0), F.col("_passes") - 1)))
    # A hash of no bits would be shifted by 64, which is a shift by none: the two shifts add up.
    uses = uses.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "replica")).withColumn("_part", F.shiftrightunsigned(F.shiftrightunsigned("_h", 63 - bits), 1).cast("int"))
    at = ["_source", "replica", "_part"]
    sums = uses.groupBy(at).agg(F.sum("n_tokens").alias("_sum"))
    before = F.sum("_sum").over(W.partitionBy("_source").orderBy("replica", "_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select(*at, F.coalesce(before, F.lit(0)).alias("_before"))
    order = [F.expr("_h < 0"), "_h", "doc_id"]  # as unsigned numbers, which the parts are cut from
    running = F.sum("n_tokens").over(W.partitionBy(at).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    timed = uses.withColumn("_running", running).join(offsets, at)
    return timed.select("doc_id", "source", "replica", "n_tokens", ((F.col("_before") + F.col("_running")) / F.col("_share")).alias("finish"), "_h")


def _narrowed(rows: DataFrame, key: str, low: float, high: float, budget: int) -> tuple[float, float, int, int] | None:
    """The part, of TIME_PARTS equal ones between `low` and `high`, in which rows in the order of `key` exceed the budget: its
    least and greatest key, the tokens before it, its rows. None if all rows together do not."""
    width = (high - low) / TIME_PARTS or 1.0
    part = F.floor((F.col(key).cast("double") - F.lit(low)) / F.lit(width)).alias("_p")
    sums = rows.groupBy(part).agg(F.sum("n_tokens").alias("_sum"), F.count("*").alias("_rows"), F.min(key).alias("_low"), F.max(key).alias("_high"))
    before = 0
    for r in sorted(sums.collect(), key=lambda r: r["_p"]):  # TIME_PARTS + 1 rows at most
        if before + r["_sum"] > budget:
            return r["_low"], r["_high"], before, r["_rows"]
        before += r["_sum"]
    return None


def cut_at_budget(times: DataFrame, budget: int) -> DataFrame:
    """The uses, in order of finish time, hash and document, that together hold no more than `budget` tokens.

    The finish time at which the budget ends is searched by sums over parts of the time, then of that part, and so on; uses
    with one and the same time are told apart by their hashes in the same way. Only when a part has no more than MOST_ROWS
    uses is it summed row by row. `times` is read once per step, of which there are two for 10^11 uses, and should be cut."""
    kept, rows, left = [], times, budget
    for key in ("finish", "_h"):
        ends = rows.agg(F.min(key).alias("a"), F.max(key).alias("b"), F.count("*").alias("n")).first()
        if not ends["n"]:
            return times.drop("_h")
        low, high, n = ends["a"], ends["b"], ends["n"]
        while n > MOST_ROWS and low < high:
            found = _narrowed(rows.where(F.col(key).between(low, high)), key, float(low), float(high), left)
            if found is None:
                return times.drop("_h") if not kept else _union([*kept, rows]).drop("_h")
            narrower = (found[0], found[1]) != (low, high)
            n, left = found[3], left - found[2]
            kept.append(rows.where(F.col(key).between(low, high) & (F.col(key) < F.lit(found[0]))))
            low, high = found[0], found[1]
            if not narrower:
                break
        rows = rows.where(F.col(key).between(low, high))
        if n <= MOST_ROWS:
            break
    running = F.sum("n_tokens").over(W.partitionBy(F.lit(0)).orderBy("finish", "_h", "doc_id", "replica", "source").rowsBetween(W.unboundedPreceding, 0))
    inside = rows.withColumn("_run", running).where(F.col("_run") <= left).drop("_run")
    return _union([*kept, inside]).drop("_h")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def budget_of(docs: DataFrame, targets: DataFrame) -> int:
    """All tokens of documents from sources with a target, each document once."""
    own = docs.select(clean_source("source").alias("_source"), "n_tokens").join(F.broadcast(targets), "_source", "left_semi")
    return int(own.agg(F.sum("n_tokens")).first()[0] or 0)


def short_sources(times: DataFrame, mixed: DataFrame, targets: DataFrame, budget: int) -> DataFrame:
    """Sources that cannot fill their share: all their possible uses are in the mix, and even the last one finishes before
    the virtual time of the budget. A source without documents finishes at 0."""
    use = lambda df, n, t: df.groupBy("source").agg(F.count("*").alias(n), F.max("finish").alias(t))
    both = targets.join(use(times, "_possible", "_end"), "source", "left").join(use(mixed, "_used", "_last"), "source", "left")
    all_used = F.coalesce("_possible", F.lit(0)) == F.coalesce("_used", F.lit(0))
    return both.where(all_used & (F.coalesce("_last", F.lit(0.0)) < F.lit(float(budget)))).select("source")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and actual share, tokens and uses of each source with a target."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_uses"), F.count_distinct("doc_id").alias("n_documents"))
    rows = targets.join(got, "source", "left").withColumn("_all", F.sum("n_tokens").over(W.partitionBy(F.lit(0))))  # MAX_SOURCES rows at most
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return rows.select("source", F.col("_share").alias("target_share"), (F.coalesce("n_tokens", F.lit(0)) / F.col("_all")).alias("actual_share"), zero("n_tokens"), zero("n_uses"), zero("n_documents"))
