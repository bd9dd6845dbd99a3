"""Process only the part files that arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.extract import ExtractSpec, extract
from ..sources.readers import CSV_OPTIONS


def ingest_new(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    destination: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    spec: ExtractSpec | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Run a stateless extract over files not seen before, then stop.

    A file-source stream with ``availableNow``: the checkpoint holds the manifest, so
    a second run over an unchanged folder adds nothing and a restart resumes.
    ``max_files`` bounds a micro-batch.  Row limits are refused, since a limit is not
    stateless.
    """
    if spec is not None and spec.row_limit:
        raise ValueError("a row limit cannot be applied to a stream")
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.format(fmt).load(folder)
    if spec is not None:
        rows = extract(rows, spec)
    if transform is not None:
        rows = rows.transform(transform)
    query = (
        rows.writeStream.format("parquet")
        .option("path", destination)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
