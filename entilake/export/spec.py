"""What an export includes: filters, presets, fingerprints and file names."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ExportSpec:
    """None includes all languages, sites or property types; an empty tuple includes none."""

    languages: tuple[str, ...] | None = None
    sites: tuple[str, ...] | None = None
    property_types: tuple[str, ...] | None = None
    statements: bool = True
    references: bool = True

    def includes_language(self, code: Column) -> Column:
        return _within(code, self.languages)

    def includes_site(self, site: Column) -> Column:
        return _within(site, self.sites)

    def includes_type(self, datatype: Column) -> Column:
        """An unknown datatype is excluded as soon as there is a list."""
        return _within(datatype, self.property_types)

    def describe(self) -> list[str]:
        """Settings in words."""
        listed = lambda what, x: f"{what}: {'all' if x is None else 'none' if not x else ', '.join(x)}"
        return [listed("languages", self.languages), listed("sites", self.sites), listed("property types", self.property_types), f"statements: {'yes' if self.statements else 'no'}", f"references: {'yes' if self.references else 'no'}"]

    def fingerprint(self) -> str:
        """Short hash of the settings, the same in every run."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:16]


def _within(value: Column, allowed: tuple[str, ...] | None) -> Column:
    if allowed is None:
        return F.lit(True)
    return F.coalesce(value.isin(*allowed), F.lit(False)) if allowed else F.lit(False)


#: Filters that each format fixes; the others are free.
PRESETS: dict[str, dict] = {
    "turtle": {},
    "turtle-stats": {"languages": (), "sites": ()},
    "turtle-links": {"languages": (), "statements": False},
    "turtle-labels": {"sites": (), "statements": False},
    "kb": {},
}


def preset(name: str, spec: ExportSpec | None = None) -> ExportSpec:
    """The filters of a format, over those asked for."""
    return ExportSpec(**(asdict(spec or ExportSpec()) | PRESETS[name]))


def result_name(name: str, date: str, spec: ExportSpec) -> str:
    """File name of an export. The fingerprint is in it only where a filter that matters for the format is not the default;
    the line format has no filters."""
    suffix = {"kb": "kb.gz"}.get(name, "ttl.gz")
    effective, plain = preset(name, spec), preset(name)
    if not effective.statements:
        effective, plain = (ExportSpec(e.languages, e.sites, None, False) for e in (effective, plain))
    marked = "" if name == "kb" or effective == plain else f"-{effective.fingerprint()}"
    return f"{name}-{date}{marked}.{suffix}"
