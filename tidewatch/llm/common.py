"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

#: White space of the text contracts, as the inside of a regex class (Java and Python).
WS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts lineage: later stages restart from these files when executors are
    lost, and the two sides of a later join are plain shuffles that adaptive
    execution can split when a key is hot.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the folders of ``written`` frames that nothing will read again.

    Only for frames whose every result is itself written: a lost executor then
    never needs them.  A folder that pyarrow cannot open stays."""
    from pyarrow.fs import FileSystem
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            try:
                fs, path = FileSystem.from_uri(folder)
                fs.delete_dir(path)
            except (pa.ArrowException, OSError):
                pass


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows (bounds Python memory)."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
