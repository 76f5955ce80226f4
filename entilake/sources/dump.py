"""XML revision dumps: which files to read, and their revisions as rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entilake.functions.text import unquote_entities
from entilake.operators.revisions import entity_pages, union_sources

#: Layout of a data folder (fixed values): folder and file of full dumps with history, of current dumps, and of dailies.
LAYOUT = {"history": ("dump", "pages-meta-history.xml.bz2"), "current": ("curdump", "pages-meta-current.xml.bz2"), "daily": ("daily", "pages-meta-hist-incr.xml.bz2")}
#: No dump yet, and no bound on dates (fixed values; both compare as texts).
NO_DUMP, ANY_TIME = "00000000", "ANYTIME"

REVISION = "id BIGINT, timestamp STRING, contributor STRUCT<username: STRING, ip: STRING>, text STRING"
PAGE = "title STRING, id BIGINT, revision ARRAY<STRUCT<id: BIGINT, timestamp: STRING, contributor: STRUCT<username: STRING, ip: STRING>, text: STRING>>"
_END, _REVISION_END = "</page>\n", "</revision>\n"
_WANTED = r"^(Q[0-9]+|Property:P[0-9]+)$"


@dataclass(frozen=True)
class DumpFiles:
    """The files to read, newest first: dailies from the dump's date on, then the dump."""

    dump_date: str
    dailies: list[str]
    paths: list[str]

    @property
    def latest_date(self) -> str:
        """Date of the newest data: the newest daily, or the dump."""
        return self.dailies[0] if self.dailies else self.dump_date


def _dates(spark: SparkSession, root: str, kind: str) -> list[str]:
    folder, name = LAYOUT[kind]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}*/{name}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    names = [f.getPath().getParent().getName() for f in found]
    return sorted(m.group(1) for n in names if (m := re.fullmatch(rf"{folder}(\d{{8}})", n)))


def plan_files(spark: SparkSession, root: str, current: bool = False, max_date: str = ANY_TIME) -> DumpFiles:
    """The newest dump not after `max_date` and the dailies from its date to `max_date`. Only names are looked at; the list
    of files is as long as there are days since a dump."""
    kind = "current" if current else "history"
    at = lambda k, date: f"{root}/{LAYOUT[k][0]}{date}/{LAYOUT[k][1]}"
    dump = max((x for x in _dates(spark, root, kind) if x <= max_date), default=NO_DUMP)
    dailies = [x for x in reversed(_dates(spark, root, "daily")) if dump <= x <= max_date]
    return DumpFiles(dump, dailies, [at("daily", x) for x in dailies] + ([at(kind, dump)] if dump != NO_DUMP else []))


def _pages(text: DataFrame) -> DataFrame:
    """Pages of items and properties from page-sized texts; a cheap look at the title comes before the parser."""
    body = F.regexp_extract("value", r"(?s)(<page>.*)$", 1)
    wanted = text.where(F.col("value").rlike(r"<title>(Q[0-9]+|Property:P[0-9]+)</title>"))
    return wanted.select(F.from_xml(F.concat(body, F.lit("</page>")), PAGE, {"mode": "PERMISSIVE"}).alias("page")).where("page.title is not null")


def _revision_columns(each: DataFrame) -> DataFrame:
    """Rows of (title, r) with title, entity, entity_id, is_item, rev_id, ts, user_name (empty where hidden), is_ip, content."""
    flat = each.select("title", F.col("r.id").alias("rev_id"), F.col("r.timestamp").alias("ts"), F.coalesce("r.contributor.ip", "r.contributor.username", F.lit("")).alias("user_name"), F.col("r.contributor.ip").isNotNull().alias("is_ip"), F.col("r.text").alias("content"))
    return entity_pages(flat)


def revisions_of(pages: DataFrame) -> DataFrame:
    """Revisions of parsed pages as rows, see _revision_columns."""
    return _revision_columns(pages.select(F.col("page.title").alias("title"), F.explode("page.revision").alias("r")))


def _titled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records (path, start, value) with the title of their page: the last one seen in their split. Records before the first
    title of a split have none; those of pages that are no entities are left out. Texts are not made Python objects."""
    at, carried = None, pa.scalar(None, pa.string())
    for batch in batches:
        if not batch.num_rows:
            continue
        path, start = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(zero_copy_only=False)
        place, names = path.indices.to_numpy(), path.dictionary
        found = pc.struct_field(pc.extract_regex(batch.column(2), r"<title>(?P<t>[^<]*)</title>"), "t")
        turns = np.flatnonzero((np.diff(place) != 0) | (np.diff(start) != 0)) + 1
        parts = []
        for a, b in zip([0, *turns], [*turns, batch.num_rows]):
            here = (names[place[a]].as_py(), int(start[a]))
            head = carried if here == at else pa.scalar(None, pa.string())
            filled = pc.fill_null_forward(pa.concat_arrays([pa.array([head.as_py()], pa.string()), found.slice(a, b - a).cast(pa.string())]))
            at, carried = here, filled[len(filled) - 1]
            parts.append(filled.slice(1))
        title = pa.concat_arrays(parts)
        kept = pc.fill_null(pc.match_substring_regex(title, _WANTED), True)
        yield pa.RecordBatch.from_arrays([*batch.columns, title], names=["_path", "_start", "value", "title"]).filter(kept)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """A file as records that end with a revision, with their split; damaged files are read as far as they go."""
    reader = spark.read.option("lineSep", _REVISION_END).option("ignoreCorruptFiles", "true")
    return reader.text(path).select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), "value")


def _first_titles(records: DataFrame) -> DataFrame:
    """(path, start, carried): for each split the last title in the splits before it. One row per split meets in a window."""
    title = F.regexp_extract("value", r"<title>([^<]*)</title>", 1)
    last = records.select("_path", "_start", title.alias("_t"), F.monotonically_increasing_id().alias("_i")).groupBy("_path", "_start").agg(F.max_by(F.when(F.col("_t") != "", F.col("_t")), F.when(F.col("_t") != "", F.col("_i"))).alias("_last"))
    before = W.partitionBy("_path").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)
    return last.select("_path", "_start", F.last("_last", True).over(before).alias("_carried"))


def read_dump_file(spark: SparkSession, path: str) -> DataFrame:
    """Revisions of one file, with rev_id NULL where one cannot be parsed. The file is split at the ends of revisions, so a
    compressed file is read by many tasks and a page may be of any length. Where a file has more than one split, a first pass
    finds the title at the start of each."""
    records = _records(spark, path)
    titled = records.mapInArrow(_titled, "_path string, _start bigint, value string, title string")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).getLen()
    if size > int(spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()):  # no smaller file is split
        whole = titled.join(_first_titles(records), ["_path", "_start"], "left")
        titled = whole.withColumn("title", F.coalesce("title", "_carried")).where(F.col("title").rlike(_WANTED))
    body = F.regexp_extract("value", r"(?s)(<revision>.*)$", 1)
    each = titled.where(F.col("title").isNotNull() & F.col("value").contains("<revision>"))
    parsed = each.select("title", F.from_xml(F.concat(body, F.lit("</revision>")), REVISION, {"mode": "PERMISSIVE"}).alias("r"))
    return _revision_columns(parsed)


def read_dumps(spark: SparkSession, files: DumpFiles, rejected: Observation | None = None) -> DataFrame:
    """Revisions of all files with file_rank, 0 for the newest file. Without files, an empty table. rejected: gets the number
    of revisions that could not be parsed (n_rejected), when the result is computed."""
    if not files.paths:
        empty = spark.createDataFrame([], "value string")
        return revisions_of(_pages(empty)).withColumn("file_rank", F.lit(0))
    found = union_sources([read_dump_file(spark, p) for p in files.paths])
    if rejected is not None:
        found = found.observe(rejected, F.count_if(F.col("rev_id").isNull()).alias("n_rejected"))
    return found.where("rev_id is not null")


def first_seen(revisions: DataFrame) -> DataFrame:
    """Each revision with content once, from the newest file that has it."""
    rest = [c for c in revisions.columns if c not in ("rev_id", "file_rank")]
    best = F.min(F.struct("file_rank", *rest)).alias("_b")
    return revisions.where(F.col("content") != "").groupBy("rev_id").agg(best).select("rev_id", "_b.*")


def latest_entities(revisions: DataFrame, mode: str = "first_block", max_date: str = "") -> DataFrame:
    """Newest state of each entity. `first_block`: the highest revision with content in the newest file that has a page of
    the entity, none if that file has no content of it; `global`: the highest revision anywhere. max_date: only revisions
    with a smaller time stamp; the newest file is that of all revisions, so an entity whose newest file has only later ones
    has no state."""
    rows = revisions
    fit = (F.col("content") != "") & (F.lit(max_date) > F.col("ts") if max_date else F.lit(True))
    usable = F.when(F.coalesce(fit, F.lit(False)), F.struct("rev_id", *[c for c in revisions.columns if c not in ("entity", "rev_id", "file_rank")]))
    by_file = rows.groupBy("entity", "file_rank").agg(F.max(usable).alias("_best"))
    if mode == "global":
        found = by_file.groupBy("entity").agg(F.max("_best").alias("_best"))
    else:
        found = by_file.groupBy("entity").agg(F.min(F.struct("file_rank", "_best")).alias("_n")).select("entity", F.col("_n._best").alias("_best"))
    return found.where("_best is not null").select("entity", "_best.*")


#: Parts of an entity's content (fixed names of the data model).
PARTS = "label string, description string, aliases string, links string, claims string, datatype string"


def entity_contents(entities: DataFrame, *more: str) -> DataFrame:
    """Contents of entities as texts per part: label, description, aliases, links, claims, datatype; with columns `more`.
    A content in which `&quot;` stands for all quotes is decoded first; one that is no JSON has only NULL parts."""
    text = F.when(F.col("content").rlike(r"^\s*\{\s*&quot;"), unquote_entities(F.col("content"))).otherwise(F.col("content"))
    parsed = F.from_json(text, PARTS)
    return entities.withColumn("_c", parsed).select("entity", "entity_id", "is_item", F.col("rev_id").alias("rev"), "ts", *more, "_c.*")
