"""Change journal between the silver merges and the gold job.

A merge notes what it is going to change *before* it appends (``open``) and
says so again when its rows are in the table (``closed``).  Notes are numbered
per table; a table has one merge at a time, so a merge's number is the one
after the last.  The gold job keeps, per table, the number up to which it has
consumed notes; no clock is involved:

* a note that is not in silver yet, or whose merge died, stays open and stops the
  number there: its windows are scored now and again in the next run;
* a merge that ends while gold runs was open when gold read the journal, so the
  next run takes it up;
* a merge that died before its append changed nothing, and one that died after
  it is scored; the next merge of the table closes what an earlier one left.

Layout: ``silver/changes/source=<table>/seq=<n>/phase=<open|closed>`` and
``gold/consumed``.  Consumed notes are deleted (:func:`compact`).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSED = "open", "closed"
_LOWS = [T.StructField("asset_symbol", T.StringType()), T.StructField("low", T.TimestampNTZType())]
NOTES = T.StructType(_LOWS + [T.StructField("source", T.StringType()),
                              T.StructField("seq", T.LongType()),
                              T.StructField("phase", T.StringType())])
CONSUMED = T.StructType([T.StructField("source", T.StringType()),
                         T.StructField("seq", T.LongType())])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # nothing noted yet


def consumed(spark: SparkSession, layout) -> dict[str, int]:
    """Per table, the number up to which gold has consumed notes."""
    rows = _read(spark, layout.gold_consumed, CONSUMED).groupBy("source").agg(
        F.max("seq").alias("seq")).collect()  # one row per table
    return {r.source: r.seq for r in rows}


def _states(spark: SparkSession, layout) -> list[tuple[str, int, bool]]:
    """(table, number, closed) of the notes that are left, in order."""
    rows = (_read(spark, layout.silver_changes, NOTES).groupBy("source", "seq")
            .agg(F.max((F.col("phase") == CLOSED)).alias("closed")).collect())  # one per merge
    return sorted((r.source, r.seq, r.closed) for r in rows)


def _folder(layout, table: str, seq: int, phase: str) -> str:
    return f"{layout.silver_changes}/source={table}/seq={seq}/phase={phase}"


def last_number(spark: SparkSession, layout, table: str) -> int:
    return max([consumed(spark, layout).get(table, 0)]
               + [n for t, n, _ in _states(spark, layout) if t == table])


def open_note(spark: SparkSession, layout, table: str, lows: DataFrame) -> int:
    """Note that a merge is about to bring rows (``asset_symbol``, ``low``) into
    ``table``; fails if another merge has taken the number."""
    seq = last_number(spark, layout, table) + 1
    rows = lows.select("asset_symbol", "low").union(
        spark.createDataFrame([(None, None)], T.StructType(_LOWS)))  # a note has a row at least
    rows.coalesce(1).write.mode("errorifexists").parquet(_folder(layout, table, seq, OPEN))
    return seq


def open_notes(spark: SparkSession, layout, table: str) -> list[int]:
    return [n for t, n, closed in _states(spark, layout) if t == table and not closed]


def close_notes(spark: SparkSession, layout, table: str, numbers: list[int]) -> None:
    for seq in numbers:  # one, and those of merges that died
        spark.createDataFrame([(None, None)], T.StructType(_LOWS)).coalesce(1).write.mode(
            "overwrite").parquet(_folder(layout, table, seq, CLOSED))


def lows_of(spark: SparkSession, layout, table: str, numbers: list[int] | None = None) -> DataFrame:
    """``asset_symbol``, ``low`` of the unconsumed notes of ``table`` (or of those numbered)."""
    notes = _read(spark, layout.silver_changes, NOTES).where(
        (F.col("source") == table) & (F.col("phase") == OPEN) & F.col("low").isNotNull())
    wanted = (F.col("seq").isin(numbers) if numbers is not None
              else F.col("seq") > consumed(spark, layout).get(table, 0))
    return notes.where(wanted).select("asset_symbol", "low")


def settled(spark: SparkSession, layout) -> dict[str, int]:
    """Per table, the last number with no open note up to it.  Read before silver
    is: what is settled then is in the rows that a run reads afterwards."""
    marks = consumed(spark, layout)
    stopped = set()
    for table, seq, closed in _states(spark, layout):
        if seq <= marks.get(table, 0) or table in stopped:
            continue
        if closed:
            marks[table] = seq
        else:
            stopped.add(table)
    return marks


def consume(spark: SparkSession, layout, marks: dict[str, int]) -> None:
    """Store how far gold has come (after its rows are in the table)."""
    before = consumed(spark, layout)
    new = [(t, n) for t, n in marks.items() if n > before.get(t, 0)]
    if new:
        spark.createDataFrame(new, CONSUMED).coalesce(1).write.mode("append").parquet(
            layout.gold_consumed)


def compact(spark: SparkSession, layout) -> int:
    """Delete the folders of consumed notes; returns how many went.  A file system
    that pyarrow cannot open keeps them (they are skipped by number)."""
    import pyarrow as pa
    from pyarrow.fs import FileSystem
    marks, gone = consumed(spark, layout), 0
    for table, seq, _ in _states(spark, layout):
        if seq > marks.get(table, 0):
            continue
        folder = _folder(layout, table, seq, OPEN).rsplit("/", 1)[0]
        try:
            fs, path = FileSystem.from_uri(folder)
            fs.delete_dir(path)
            gone += 1
        except (pa.ArrowException, OSError):
            pass
    return gone
