"""Feature files: Parquet with a ``features`` array and a ``target``."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.load_files import file_system

# Read wide, then narrowed: files may hold floats or doubles.
WIDE = "features array<double>, target double"


def read_feature_files(spark: SparkSession, folder: str) -> DataFrame:
    """All ``*.parquet`` below ``folder`` at any depth, as float32. Unreadable files are skipped,
    and files that lack one of the two columns give no rows; ``unreadable_files`` names them."""
    files = (
        spark.read.schema(WIDE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", True)
        .parquet(folder)
    )
    return files.where(F.col("features").isNotNull() & F.col("target").isNotNull()).select(
        F.col("features").cast("array<float>").alias("features"),
        F.col("target").cast("float").alias("target"),
    )


def unreadable_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, reason`` of every ``*.parquet`` below ``folder`` that ``read_feature_files`` takes no rows from: no Parquet file, or one
    without one of the columns. Only the ends of the files are read, in tasks that the files are dealt out to."""
    # the list of names, which a scan leaves empty files out of
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder).inputFiles()
    listed = spark.createDataFrame([(unquote(n),) for n in names], "path string").repartition("path")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                store, place = file_system(path)
                try:
                    with store.open_input_file(place) as source:
                        names = pq.ParquetFile(source).schema_arrow.names
                except (pa.ArrowInvalid, OSError) as error:
                    found.append((path, f"not readable: {str(error).splitlines()[0]}"))
                    continue
                missing = [c for c in ("features", "target") if c not in names]
                if missing:
                    found.append((path, f"no column {' and no column '.join(missing)}"))
            columns = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["file", "reason"])

    return listed.mapInArrow(look, "file string, reason string")


def write_feature_files(labelled: DataFrame, folder: str, columns: list[str]) -> None:
    """Write labelled rows in that form."""
    rows = labelled.select(
        F.array(*(F.col(c).cast("float") for c in columns)).alias("features"),
        F.col("label").cast("float").alias("target"),
    )
    rows.write.mode("overwrite").parquet(folder)
