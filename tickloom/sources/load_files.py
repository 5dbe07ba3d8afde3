"""Rows of the files that ledger entries name, for streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def file_system(location: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a qualified location."""
    if location.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + location[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(location)


def folder_values(path: str) -> dict[str, str | None]:
    """Columns that the folders of a path stand for."""
    pairs = (part.split("=", 1) for part in path.split("/")[:-1] if "=" in part)
    return {name: None if value == NO_VALUE else unquote(value) for name, value in pairs}


def rows_of(table: str, schema: StructType) -> Callable:
    """For ``mapInArrow`` over a column of paths below ``table``. Columns that a file lacks are null."""
    wanted = to_arrow_schema(schema)

    def column(batch: pa.RecordBatch, values: dict, f: pa.Field) -> pa.Array:
        if f.name in batch.schema.names:
            found = batch.column(f.name)
            if pa.types.is_timestamp(found.type) and found.type.tz is None:
                found = found.cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
            return found.cast(f.type)
        return pa.array([values.get(f.name)] * batch.num_rows, pa.string()).cast(f.type)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(table)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                values = folder_values(path)
                try:
                    source = store.open_input_file(f"{root}/{path}")
                except FileNotFoundError:
                    raise FileNotFoundError(f"{path} of {table} was cleaned away: the stream is behind what is kept") from None
                with source:
                    file = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
                    names = [n for n in file.schema_arrow.names if n in wanted.names]
                    for part in file.iter_batches(columns=names):
                        yield pa.RecordBatch.from_arrays([column(part, values, f) for f in wanted], schema=wanted)

    return read
