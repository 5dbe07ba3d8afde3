"""Ad-hoc SQL over the layer views."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession


@dataclass(frozen=True)
class SqlResult:
    """``frame`` is the whole result, not yet computed; ``error`` says why there is none."""

    frame: DataFrame | None = None
    error: str | None = None

    def rows(self) -> Iterator[Row]:
        """All rows, in order, in one run; the driver holds one partition at a time."""
        return iter(()) if self.frame is None else self.frame.toLocalIterator()

    def page(self, size: int) -> list[Row]:
        return [] if self.frame is None else self.frame.limit(size).collect()


def run_sql(spark: SparkSession, text: str, args: dict | None = None) -> SqlResult:
    """Analyse ``text``; a mistake in it comes back as its message. Values go in as named ``args``
    (``:name``)."""
    try:
        return SqlResult(spark.sql(text, args=args))
    except PySparkException as problem:
        return SqlResult(error=str(problem))
