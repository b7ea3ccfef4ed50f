"""Line deduplication by overlapping three-line windows.

Every run of ``WINDOW`` consecutive lines is hashed (128 bits).  A window that
occurs more than once in the corpus keeps its first occurrence, by document,
then position; all later ones are covered.  The covered positions of a
document are merged into spans, and the spans' lines are removed.  Every line
that goes stands in an earlier, kept place.

Only hashes are shuffled to find repeats, pre-combined in every map task;
the text moves once, to meet its spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WS, table, text_or_empty, written

WINDOW = 3
SPANS = "array<struct<first:int,after:int>>"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def _comparable(line: Column) -> Column:
    """Lines are compared without white space at their ends."""
    return F.regexp_replace(line, f"^[{WS}]+|[{WS}]+$", "")


def _row_key() -> list[Column]:
    # rows that share a doc_id but not the text are different documents
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("_t")]


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id``, ``_t``, ``pos``, ``a``, ``b``: each window's place and hash.

    Windows of blank lines only are left out.
    """
    rows = docs.select(*_row_key(), F.explode(F.array(
        F.transform(lines_of(text_or_empty()), _comparable))).alias("_lines"))
    rows = rows.filter(F.size("_lines") >= size)

    def window(at: Column) -> Column:
        part = [F.get("_lines", at + k) for k in range(size)]
        return F.struct(at.alias("pos"), F.xxhash64(*part).alias("a"),
                        F.xxhash64(F.lit(1), *part).alias("b"),
                        (F.concat(*part) != "").alias("filled"))

    # hashes are made inside the array: an exploded row never carries the lines
    return rows.select("doc_id", "_t", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("_lines") - size), window)).alias("w")).filter(
        "w.filled").select("doc_id", "_t", "w.pos", "w.a", "w.b")


def repeated_spans(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id``, ``_t``, ``spans``: merged line spans of later occurrences."""
    places = written(windows(docs, size), "line-windows")
    at = F.struct("doc_id", "_t", "pos")
    firsts = written(places.groupBy("a", "b").agg(F.min(at).alias("first"), F.count("*").alias("n"))
                     .filter("n > 1").drop("n"), "repeated-windows")
    later = places.join(firsts, ["a", "b"]).filter(at > F.col("first"))
    return later.groupBy("doc_id", "_t").agg(
        F.sort_array(F.collect_set("pos")).alias("at")).select(  # positions of one document
        "doc_id", "_t", F.expr(f"""
          aggregate(at, cast(array() as {SPANS}), (s, p) ->
            if(size(s) > 0 and element_at(s, -1).after >= p,
               concat(slice(s, 1, size(s) - 1), array(
                 named_struct('first', element_at(s, -1).first, 'after', p + {size}))),
               concat(s, array(named_struct('first', p, 'after', p + {size})))))
        """).alias("spans"))


def dedup_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_lines``, ``n_removed``, ``spans``, ``text``.

    ``text`` is what remains; ``spans`` are the removed line ranges of the
    original (first, and one after the last).

    * a null text counts as empty and has one empty line; documents with
      fewer than ``size`` lines are unchanged;
    * the first occurrence is by ``doc_id`` (nulls first), then position; rows
      that repeat both ``doc_id`` and text are one place, and keep the same lines;
    * other columns are not read; an empty table gives no rows.
    """
    found = written(repeated_spans(docs, size), "line-spans").select(
        F.col("doc_id").alias("_id"), F.col("_t").alias("_key"), "spans")
    rows = docs.select(*_row_key(), text_or_empty().alias("text"))
    # the spans grow with the corpus: no broadcast, so cost grows alike at every size
    rows = rows.join(found.hint("merge"), rows["doc_id"].eqNullSafe(found["_id"])
                     & (rows["_t"] == found["_key"]), "left")
    rows = rows.select("doc_id", "text", F.coalesce("spans", F.expr(f"cast(array() as {SPANS})"))
                       .alias("spans"), F.explode(F.array(lines_of(F.col("text")))).alias("_lines"))
    kept = F.expr("""
      flatten(transform(sequence(0, size(spans)), i -> slice(_lines,
        if(i = 0, 1, spans[i - 1].after + 1),
        if(i = size(spans), size(_lines), spans[i].first) - if(i = 0, 0, spans[i - 1].after))))""")
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["after"] - s["first"])
    return rows.select("doc_id", F.size("_lines").alias("n_lines"), removed.alias("n_removed"),
                       "spans", F.when(F.size("spans") == 0, F.col("text"))
                       .otherwise(F.array_join(kept, "\n")).alias("text"))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed",
        F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["first"], s["after"])), ",")
        .alias("spans"), "text", F.sha2("text", 256).alias("text_sha256"))


ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM d),
c AS (SELECT doc_id, pos, line,
             regexp_replace(line, '^[{WS}]+|[{WS}]+$', '', 'g') AS x FROM l),
n AS (SELECT doc_id, pos, x, lead(x, 1) OVER w AS y, lead(x, 2) OVER w AS z FROM c
      WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
o AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, pos) AS r
      FROM n WHERE z IS NOT NULL AND x || y || z <> ''),
g AS (SELECT DISTINCT doc_id, pos + k AS pos FROM o, (SELECT unnest([0, 1, 2]) AS k) WHERE r > 1),
m AS (SELECT c.doc_id, c.pos, c.line, g.pos IS NOT NULL AS gone
      FROM c LEFT JOIN g ON c.doc_id = g.doc_id AND c.pos = g.pos),
i AS (SELECT doc_id, min(pos) || '-' || max(pos) + 1 AS span, min(pos) AS low FROM (
        SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island
        FROM m WHERE gone) GROUP BY doc_id, island),
s AS (SELECT doc_id, string_agg(span, ',' ORDER BY low) AS spans FROM i GROUP BY doc_id),
t AS (SELECT doc_id, count(*)::INTEGER AS n_lines,
             (count(*) FILTER (WHERE gone))::INTEGER AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
      FROM m GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, coalesce(spans, '') AS spans, text, sha256(text) AS text_sha256
FROM t LEFT JOIN s USING (doc_id)"""
