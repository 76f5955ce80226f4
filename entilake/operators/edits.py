"""Edits per day and per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entilake.functions.days import date_text, day_date, day_index
from entilake.functions.text import csv_name, yes_no
from entilake.session import cut

#: Bot accounts beyond this number are looked up by a shuffled join instead of a broadcast one.
MAX_BROADCAST_BOTS = 100_000


def with_bot_flag(df: DataFrame, bots: DataFrame, user: str = "user_name") -> DataFrame:
    """is_bot: the user is in `bots` (column bot_name), exactly as written; NULL users are none. Repeated and NULL names in
    the list change nothing."""
    names = bots.select(F.col("bot_name").alias("_bot")).where(F.col("_bot").isNotNull()).distinct()
    small = names.limit(MAX_BROADCAST_BOTS + 1).count() <= MAX_BROADCAST_BOTS
    listed = F.broadcast(names) if small else names
    return df.join(listed, F.col(user) == F.col("_bot"), "left").withColumn("is_bot", F.col("_bot").isNotNull()).drop("_bot")


def editor_class(is_ip: Column, is_bot: Column) -> Column:
    """An address wins over a bot's name."""
    return F.when(F.coalesce(is_ip, F.lit(False)), "anon").when(is_bot, "bot").otherwise("human")


def edits_per_day(df: DataFrame, bots: DataFrame, day: str) -> DataFrame:
    """index, date, bots, humans, anons, total for each day between the first and the last one, zeros where nobody
    edited. df: user_name, is_ip and the DATE column `day`; rows without a day are left out. No rows give no days."""
    kind = editor_class(F.col("is_ip"), F.col("is_bot"))
    dated = with_bot_flag(df.where(F.col(day).isNotNull()), bots).select(day_index(F.col(day)).alias("index"), kind.alias("_k"))
    n = lambda k: F.count_if(F.col("_k") == k)
    counts = cut(dated.groupBy("index").agg(n("bot").alias("bots"), n("human").alias("humans"), n("anon").alias("anons")))  # a row a day
    spine = counts.agg(F.min("index").alias("a"), F.max("index").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias("index"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    filled = spine.join(counts, "index", "left").select("index", date_text(day_date(F.col("index"))).alias("date"), zero("bots"), zero("humans"), zero("anons"))
    return filled.withColumn("total", F.col("bots") + F.col("humans") + F.col("anons"))


def edits_per_user(df: DataFrame, bots: DataFrame) -> DataFrame:
    """user, ip, bot, edits: a name used as an address and as an account is two users; a hidden user is the empty name."""
    counts = df.groupBy(F.coalesce("user_name", F.lit("")).alias("user_name"), F.coalesce("is_ip", F.lit(False)).alias("is_ip")).agg(F.count("*").alias("edits"))
    flagged = with_bot_flag(counts, bots)
    return flagged.select(csv_name(F.col("user_name")).alias("user"), yes_no(F.col("is_ip")).alias("ip"), yes_no(F.col("is_bot")).alias("bot"), "edits")


def edit_totals(per_user: DataFrame) -> DataFrame:
    """Totals of edits_per_user: bots, humans, anons, total, accounts."""
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("edits"))), F.lit(0).cast("bigint"))
    ip, bot = F.col("ip") == "yes", F.col("bot") == "yes"
    return per_user.agg(of(~ip & bot).alias("bots"), of(~ip & ~bot).alias("humans"), of(ip).alias("anons"), F.coalesce(F.sum("edits"), F.lit(0).cast("bigint")).alias("total"), F.count("*").alias("accounts"))
