"""Many consumers of one scan, with their reports, and progress figures."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entilake.session import cut

log = logging.getLogger("entilake")


@dataclass(frozen=True)
class Consumer:
    """make: takes the revisions (or the entities) and gives a result. report: a line for the log from the result. close:
    what is to be done with the result at the end, as writing it."""

    make: Callable[[DataFrame], DataFrame]
    report: Callable[[DataFrame], str] | None = None
    close: Callable[[DataFrame], None] | None = None


class Registry:
    """Consumers by name. The source is computed once, into the shared folder, and every consumer reads it with a plan of its
    own. A consumer with a report or close has its result computed once, too."""

    def __init__(self) -> None:
        self._consumers: dict[str, Consumer] = {}

    def register(self, name: str, make: Callable[[DataFrame], DataFrame], report: Callable[[DataFrame], str] | None = None, close: Callable[[DataFrame], None] | None = None) -> None:
        if name in self._consumers:
            raise ValueError(f"a consumer {name} is registered already")
        self._consumers[name] = Consumer(make, report, close)

    def run(self, source: DataFrame) -> dict[str, DataFrame]:
        """Results by name; the number of rows read, the reports and the seconds taken are logged."""
        began, seen = time.monotonic(), Observation()
        kept = cut(source.observe(seen, F.count(F.lit(1)).alias("rows")))
        log.info("%d rows for %s in %.2f sec", seen.get["rows"], ", ".join(self._consumers), time.monotonic() - began)
        results = {}
        for name, consumer in self._consumers.items():
            result = consumer.make(kept)
            if consumer.report or consumer.close:
                result = cut(result)
            if consumer.report:
                log.info("     * %s", consumer.report(result))
            if consumer.close:
                consumer.close(result)
            log.info("%s done after %.2f sec", name, time.monotonic() - began)
            results[name] = result
        return results


def latest_report(found: DataFrame) -> str:
    """For a consumer of latest revisions."""
    return f"Number of latest revisions found: {found.count()}"


def debug_lines(revisions: DataFrame) -> DataFrame:
    """A line for each revision (entity, rev_id, ts, user_name, is_ip, file_rank), for looking into small inputs only."""
    seen = F.min("file_rank").over(W.partitionBy("entity"))
    state = F.when(F.col("file_rank") == seen, "first time").otherwise("seen before")
    text = F.format_string("%s (%s): rev %s (%s) edited by %s (IP: %s)", "entity", state, "rev_id", "ts", "user_name", F.col("is_ip").cast("string"))
    return revisions.select("entity", "file_rank", "rev_id", text.alias("line"))
