"""The line format: one statement per line, claims with qualifiers and references as blocks."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entilake.functions.dims import literal_map
from entilake.operators.entities import site_links, terms
from entilake.operators.shred import children
from entilake.session import cut
from entilake.sources.claims import claim_list


def snak_text(snak: Any) -> str:
    """Text of a full or compact snak: item `P1 Q2`, string `P1 {s}`, time and place as JSON, some value `P1 +`, no value
    `P1 -`, all else `P1 *`."""
    if not isinstance(snak, list) or len(snak) < 2:
        return "P? *"
    tag, prop = snak[0], f"P{snak[1]}"
    if tag == "somevalue":
        return f"{prop} +"
    if tag == "novalue":
        return f"{prop} -"
    if tag == "R" and len(snak) > 2:
        return f"{prop} Q{snak[2]}"
    if tag == "S" and len(snak) > 2:
        return f"{prop} {{{snak[2]}}}"
    if tag == "T" and len(snak) > 3:
        return f"{prop} {json.dumps({'precision': snak[2], 'time': snak[3]}, ensure_ascii=False)}"
    if tag == "value" and len(snak) > 3:
        kind, v = snak[2], snak[3]
        if kind == "wikibase-entityid" and isinstance(v, dict):
            return f"{prop} {'P' if v.get('entity-type') == 'property' else 'Q'}{v.get('numeric-id')}"
        if kind == "string":
            return f"{prop} {{{v}}}"
        if kind in ("time", "globecoordinate"):
            return f"{prop} {json.dumps(v, ensure_ascii=False, sort_keys=True)}"
    return f"{prop} *"


def claim_text(title: str, claim: Any) -> str:
    """Line or block of a claim."""
    if not isinstance(claim, dict):
        return f"{title} P? * ."
    inner = [f"  {snak_text(q)} ,\n" for q in children(claim.get("q"))]
    for ref in children(claim.get("refs")):
        inner += ["  reference {\n", *[f"    {snak_text(r)} ,\n" for r in children(ref)], "  },\n"]
    block = f" (\n{''.join(inner)} )" if inner else ""
    return f"{title} {snak_text(claim.get('m'))}{block} ."


def claim_lines(df: DataFrame, title: str, claims: str = "claims") -> DataFrame:
    """(title, ord, line) of all claims; rows without complete claims give none."""
    source = df.select(F.col(title).alias("title"), F.col(claims).alias("_text")).where("_text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t, i, claim_text(t, c)) for t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, c in enumerate(claim_list(x) or [])]
            if rows:
                a, b, c = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.int32()), pa.array(c, pa.string())], names=["title", "ord", "line"])

    return source.mapInArrow(run, "title string, ord int, line string")


def kb_lines(df: DataFrame, title: Column) -> DataFrame:
    """(title, part, ord, line): the lines of entities, in the order part, ord, line within one title. df: label,
    description, aliases, claims, and links and datatype where there are such; it is computed once, into the shared folder.
    Values that are no text are left out."""
    df = cut(df.select(title.alias("_title"), "label", "description", "aliases", "claims", *[c for c in ("links", "datatype") if c in df.columns]))
    kept = df.columns
    parts = []
    if "datatype" in kept:
        parts.append(df.where("datatype is not null").select("_title", F.lit(0).alias("part"), F.lit(0).alias("ord"), F.concat("_title", F.lit(" type "), "datatype", F.lit(" .")).alias("line")))
    place = F.try_element_at(literal_map({"label": 1, "description": 2, "alias": 4}), F.col("term_kind"))
    found = terms(df, ["_title"]).where("text is not null")
    parts.append(found.select("_title", place.alias("part"), F.lit(0).alias("ord"), F.concat("_title", F.lit(" "), "term_kind", F.lit(" {"), "lang", F.lit(":"), "text", F.lit("} .")).alias("line")))
    if "links" in kept:
        parts.append(site_links(df, ["_title"]).select("_title", F.lit(3).alias("part"), F.lit(0).alias("ord"), F.concat("_title", F.lit(" link {"), "site", F.lit(":"), "page", F.lit("} .")).alias("line")))
    parts.append(claim_lines(df, "_title").select(F.col("title").alias("_title"), F.lit(5).alias("part"), "ord", "line"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("_title", "title")


def entities_written(lines: DataFrame) -> int:
    """Entities with a line."""
    return lines.select("title").distinct().count()


def write_kb(lines: DataFrame, path: str, compression: str | None = "gzip", date: str | None = None) -> None:
    """Text files with the lines of each entity together and in order; entities are spread by range over the files. date: of
    the data, for a last line `# <date>` in a file of its own, after all others by name."""
    writer = lines.repartitionByRange("title").sortWithinPartitions("title", "part", "ord", "line").select("line").write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).text(path)
    if date is not None:
        end = lines.sparkSession.createDataFrame([(f"# {date}",)], "line string").coalesce(1).write.mode("overwrite")
        (end.option("compression", compression) if compression else end).text(f"{path}-end")
