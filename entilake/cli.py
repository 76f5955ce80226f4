"""Command line: analyse edits, export entities, store entities and their history, all from a folder of dumps."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from entilake.export.csv import write_csv, write_csv_parts
from entilake.export.kb import entities_written, kb_lines, write_kb
from entilake.export.spec import PRESETS, ExportSpec, preset, result_name
from entilake.export.turtle import triples, write_turtle, write_vocabulary
from entilake.functions.days import date_of
from entilake.functions.dims import canonical_datatype
from entilake.operators import edits
from entilake.operators.registry import Registry, debug_lines
from entilake.operators.snapshots import content_snapshots, historic_sums
from entilake.operators.store import merge_into, stored_entities, stored_sizes
from entilake.session import build_session, cut
from entilake.sources.dump import ANY_TIME, entity_contents, first_seen, latest_entities, plan_files, read_dumps
from entilake.sources.side_inputs import property_types, read_bots, read_seed_types

log = logging.getLogger("entilake")


def _list(text: str | None) -> tuple[str, ...] | None:
    return None if text is None else tuple(x for x in text.split(",") if x)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="entilake", description=__doc__)
    top.add_argument("--data", required=True, help="folder with dumps and dailies")
    top.add_argument("--out", required=True, help="folder for results")
    top.add_argument("--max-date", default=ANY_TIME, help="newest file to read, YYYYMMDD")
    top.add_argument("--current", action="store_true", help="use dumps of current revisions only")
    kinds = top.add_subparsers(dest="command", required=True)
    analyse = kinds.add_parser("edits", help="edits per day and per user")
    analyse.add_argument("--bots", help="JSON file with the list of bots")
    analyse.add_argument("--kb", action="store_true", help="also write the latest revisions in the line format, in the same pass")
    analyse.add_argument("--debug", action="store_true", help="also write a line for each revision")
    kinds.add_parser("store", help="latest entities as stored tables of items and properties, merged into those of earlier runs")
    history = kinds.add_parser("history", help="fortnightly content statistics, merged into those of earlier runs, and their sums")
    history.add_argument("--info", action="store_true", help="also keep languages and properties of each revision")
    kinds.add_parser("vocabulary", help="the system vocabulary as Turtle")
    export = kinds.add_parser("export", help="entities as Turtle or lines")
    export.add_argument("--format", choices=sorted(PRESETS), nargs="+", default=["turtle"])
    export.add_argument("--languages", help="codes, comma-separated; empty for none")
    export.add_argument("--sites")
    export.add_argument("--property-types")
    export.add_argument("--no-statements", action="store_true")
    export.add_argument("--no-references", action="store_true")
    export.add_argument("--seed-types", help="CSV file (property_id, datatype) for properties that declare no datatype")
    return top


def entities_of(revisions: DataFrame, seed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Latest entities with their contents, and the types of properties: declared, else from the seed list."""
    contents = cut(entity_contents(latest_entities(revisions)).withColumnRenamed("entity", "title"))
    declared = contents.where(~F.col("is_item")).select(F.col("entity_id").cast("int").alias("property_id"), canonical_datatype(F.col("datatype")).alias("datatype"))
    return contents, property_types(declared, seed)


def analyse_edits(revisions: DataFrame, a: argparse.Namespace, date: str, bots: DataFrame) -> list[str]:
    """Edits per day and per user and, if asked for, the line format of the latest revisions, from one pass over the files."""
    at = {name: f"{a.out}/{name}-{date}" for name in ("edits", "edits-by-user", "kb", "debug")}
    once = lambda df: first_seen(df.select("rev_id", "ts", "user_name", "is_ip", "file_rank", "content")).withColumn("day", date_of(F.col("ts")))
    registry = Registry()
    registry.register("edits", lambda df: edits.edits_per_day(once(df), bots, "day"), close=lambda r: write_csv(r, at["edits"], ["index"]))
    registry.register("edits-by-user", lambda df: edits.edits_per_user(once(df), bots), close=lambda r: write_csv_parts(r, at["edits-by-user"]))
    if a.kb:
        lines = lambda df: kb_lines(entity_contents(latest_entities(df)), F.col("entity"))
        report = lambda r: f"Number of latest revisions found: {entities_written(r)}"
        registry.register("kb", lines, report, lambda r: write_kb(r, at["kb"], None, date))
    if a.debug:
        registry.register("debug", debug_lines, close=lambda r: r.select("line").write.mode("overwrite").text(at["debug"]))
    return [at[name] for name in registry.run(revisions)]


def store_entities(spark: SparkSession, revisions: DataFrame, folder: str) -> list[str]:
    """Latest entities as rows of items and properties, merged into the stored ones."""
    contents = entity_contents(latest_entities(revisions))
    paths = []
    for name, rows in zip(("items", "properties"), stored_entities(contents)):
        paths.append(f"{folder}/{name}")
        log.info("%s: %s", name, stored_sizes(merge_into(spark, paths[-1], rows, ["id"])).first().asDict())
    return paths


def store_history(spark: SparkSession, revisions: DataFrame, out: str, date: str, with_info: bool) -> list[str]:
    """Fortnightly rows of items and properties, merged into the stored ones, and the report of historic sums over all."""
    found = content_snapshots(first_seen(revisions), with_info)
    items, properties = (merge_into(spark, f"{out}/{name}", rows, ["id", "day"]) for name, rows in zip(("itemrevstats", "proprevstats"), found))
    log.info("     * Recorded statistics for %d item and %d property revisions.", items.count(), properties.count())
    path = f"{out}/history-{date}"
    write_csv(historic_sums(items, "id", "day"), path, ["date"])
    return [f"{out}/itemrevstats", f"{out}/proprevstats", path]


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    """Runs a command; returns the paths written."""
    a = parser().parse_args(args)
    spark = spark or build_session()
    if a.command == "vocabulary":
        write_vocabulary(spark, f"{a.out}/vocabulary")
        return [f"{a.out}/vocabulary"]
    files = plan_files(spark, a.data, a.current, a.max_date)
    log.info("dump %s, %d dailies", files.dump_date, len(files.dailies))
    rejected = Observation()
    revisions = read_dumps(spark, files, rejected)
    paths = run(spark, a, files.latest_date, revisions)
    log.info("%d revisions could not be parsed", rejected.get["n_rejected"] if files.paths else 0)
    return paths


def run(spark: SparkSession, a: argparse.Namespace, date: str, revisions: DataFrame) -> list[str]:
    """The command on revisions; returns the paths written."""
    if a.command == "edits":
        return analyse_edits(revisions, a, date, read_bots(spark, a.bots))
    if a.command == "store":
        return store_entities(spark, revisions, a.out)
    if a.command == "history":
        return store_history(spark, revisions, a.out, date, a.info)
    asked = ExportSpec(_list(a.languages), _list(a.sites), _list(a.property_types), not a.no_statements, not a.no_references)
    contents, types = entities_of(revisions, read_seed_types(spark, a.seed_types))
    paths = []
    for name in a.format:
        spec = preset(name, asked)
        paths.append(f"{a.out}/{result_name(name, date, asked)}")
        if name == "kb":
            lines = cut(kb_lines(contents, F.col("title")))
            write_kb(lines, paths[-1])
            log.info("     * %d entities in the line format", entities_written(lines))
        else:
            write_turtle(triples(contents, "title", types, spec), types, spec, paths[-1])
    return paths


if __name__ == "__main__":
    main()
