"""Stored partial aggregates that later batches add to.

A store keeps one folder per batch, ``kind=batch/number=<n>``, and now and
then folds all batches so far into ``kind=base/number=<n>``.  Adding a batch
touches its own rows only, raw rows are never read again, and late rows are
one more batch.  A batch that is written again under its number replaces
itself, so a replay adds nothing; one that a base already holds is left out.

A base counts once its number is in the table of bases, which is written after
the base, so a fold that dies half-way changes nothing.  A store has one
writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = T.StructType([T.StructField("number", T.LongType())])


class PartialStore:
    """``merge`` turns any number of partials per group into one."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 merge: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.schema, self.merge = spark, path, schema, merge

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def folded(self) -> int:
        """The last batch that the newest base holds (-1: there is none)."""
        last = self._read(f"{self.path}/bases", _NUMBER).agg(F.max("number")).first()[0]
        return -1 if last is None else last

    def add(self, number: int, partials: DataFrame) -> bool:
        """Write a batch (again); false if a base holds it already."""
        if number <= self.folded():
            return False
        partials.select(*self.schema.names).write.mode("overwrite").parquet(
            f"{self.path}/data/kind=batch/number={number}")
        return True

    def rows(self, upto: int | None = None) -> DataFrame:
        """One row per group over the base and the batches after it."""
        fields = [T.StructField("kind", T.StringType()), T.StructField("number", T.LongType())]
        stored = self._read(f"{self.path}/data", T.StructType(self.schema.fields + fields))
        base, kind, number = self.folded(), F.col("kind"), F.col("number")
        wanted = ((kind == "base") & (number == base)) | ((kind == "batch") & (number > base))
        if upto is not None:
            wanted &= number <= upto
        return self.merge(stored.where(wanted).select(*self.schema.names))

    def fold(self, upto: int) -> None:
        """Fold the base and the batches up to ``upto`` into a new base."""
        if upto <= self.folded():
            return
        self.rows(upto).write.mode("overwrite").parquet(f"{self.path}/data/kind=base/number={upto}")
        self.spark.createDataFrame([(upto,)], _NUMBER).coalesce(1).write.mode("append").parquet(
            f"{self.path}/bases")
