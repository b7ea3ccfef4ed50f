"""Exact deduplication through content-defined chunk recipes (DataFrame functions only).

1. A normalised text is cut into chunks where its own characters say so, so a
   passage gives the same chunks wherever it stands.
2. Chunks are deduplicated: equal chunk texts meet in one aggregation that is
   pre-combined in every map task.  This is the only time that text moves.
   It verifies that a 128-bit identifier belongs to one chunk text; texts
   that share an identifier get a number each (``variants``).
3. A document becomes its recipe, the ordered list of verified identifiers.
   Documents are equal when their recipes are; only recipes are compared and
   joined from here on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WS, table, text_or_empty, written

MIN_CHUNK, MAX_CHUNK = 512, 4096
#: A chunk of at least MIN_CHUNK characters ends after these three; one without them at MAX_CHUNK.
CUT = "[aeo][dlrs] "
ID_MASK = -1


def normalized(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WS}]+", " ")


def chunks(text: Column, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> Column:
    """Content-defined chunks of a text; joined they give the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{low},{high - 3}}}?{CUT}|.{{1,{high}}}"),
                                F.lit(0))


def chunk_id(chunk: Column, mask: int = ID_MASK) -> Column:
    """128-bit identifier: two differently seeded 64-bit hashes."""
    return F.struct(F.xxhash64(chunk).bitwiseAND(mask).alias("a"),
                    F.xxhash64(F.lit(1), chunk).bitwiseAND(mask).alias("b"))


def _normal_texts(docs: DataFrame, *keep: str) -> DataFrame:
    # the generator keeps the normalised text from being computed once per use
    return docs.select(*keep, F.explode(F.array(normalized(text_or_empty()))).alias("_norm"))


def chunk_store(docs: DataFrame, mask: int = ID_MASK) -> DataFrame:
    """Distinct chunks of the corpus: ``id``, ``chunk`` and ``uses``."""
    return (_normal_texts(docs).select(F.explode(chunks(F.col("_norm"))).alias("chunk"))
            .groupBy("chunk").agg(F.count("*").alias("uses"))
            .withColumn("id", chunk_id(F.col("chunk"), mask)))


def shared_ids(store: DataFrame) -> DataFrame:
    """Identifiers that more than one distinct chunk text has (normally none)."""
    return store.groupBy("id").agg(F.count("*").alias("texts")).filter("texts > 1").select("id")


def recipes(docs: DataFrame, mask: int = ID_MASK) -> DataFrame:
    """One row per input row: ``doc_id``, ``text_sha256``, ``recipe``, ``variants``.

    ``recipe`` is the ordered list of chunk identifiers; ``variants`` tells
    apart different chunk texts that share an identifier (position, number).
    """
    shared = written(shared_ids(chunk_store(docs, mask)), "chunk-shared-ids")
    out = _normal_texts(docs, F.col("doc_id").cast("long").alias("doc_id")).select(
        "doc_id", F.sha2("_norm", 256).alias("text_sha256"),
        F.transform(chunks(F.col("_norm")), lambda c: chunk_id(c, mask)).alias("recipe"))
    if shared.isEmpty():
        return out.withColumn("variants", F.lit(None).cast("array<struct<pos:int,variant:int>>"))
    texts = _normal_texts(docs).select(F.sha2("_norm", 256).alias("text_sha256"),
                                       F.posexplode(chunks(F.col("_norm"))).alias("pos", "chunk"))
    uses = (texts.distinct().withColumn("id", chunk_id(F.col("chunk"), mask))
            .join(shared, "id", "left_semi"))
    numbers = (uses.groupBy("id", "chunk").agg(F.count("*").alias("n")).groupBy("id")
               .agg(F.sort_array(F.collect_list("chunk")).alias("all"))  # texts of one identifier
               .select("id", F.posexplode("all").alias("variant", "chunk")))
    variants = (uses.join(numbers, ["id", "chunk"]).groupBy("text_sha256")
                .agg(F.sort_array(F.collect_list(F.struct("pos", "variant"))).alias("variants")))
    return out.join(variants, "text_sha256", "left").select("doc_id", "text_sha256", "recipe",
                                                            "variants")


def exact_groups(docs: DataFrame, mask: int = ID_MASK) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, ``n_chunks``.

    * a null text counts as empty; all empty texts are one group;
    * the row with the smallest ``doc_id`` of a group stays; a null ``doc_id``
      comes after every number;
    * of rows that repeat both ``doc_id`` and text, one row stays;
    * other columns are not read; an empty table gives no rows.
    """
    rows = written(recipes(docs, mask).withColumn("_row", F.monotonically_increasing_id()),
                   "chunk-recipes")
    key = ["recipe", "variants"]
    rows = rows.withColumn("variants", F.coalesce("variants", F.expr(
        "cast(array() as array<struct<pos:int,variant:int>>)")))
    groups = written(
        rows.groupBy(*key).agg(
            F.min("doc_id").alias("keep_id"),
            F.coalesce(F.min_by("_row", "doc_id"), F.min("_row")).alias("_keep_row"),
            F.count("*").alias("group_size")).filter("group_size > 1"), "chunk-groups")
    return rows.join(groups, key, "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        "text_sha256", F.size("recipe").alias("n_chunks"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = written(exact_groups(docs).filter("not kept"), "exact-dropped")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    own = docs.select(F.struct("*").alias("_doc"),
                      F.col("doc_id").cast("long").alias("_id"),
                      F.sha2(normalized(text_or_empty()), 256).alias("_sha"))

    def hit(marks: DataFrame) -> Column:
        return own["_id"].eqNullSafe(marks["_mark_id"]) & (own["_sha"] == marks["_mark_sha"])

    def pairs(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("doc_id").alias("_mark_id"),
                           F.col("text_sha256").alias("_mark_sha")).distinct()

    copies = pairs(groups.filter(~same))
    # the copies grow with the corpus: no broadcast, so cost grows alike at every size
    kept = own.join(copies.hint("merge"), hit(copies), "left_anti")
    if groups.filter(same).isEmpty():
        return kept.select("_doc.*")
    repeated = pairs(groups.filter(same))  # rows that repeat doc_id and text: one of each stays
    return (kept.join(repeated, hit(repeated), "left_anti").select("_doc.*").unionByName(
        own.join(repeated, hit(repeated), "left_semi").dropDuplicates(["_id", "_sha"])
        .select("_doc.*")))


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("n_chunks")


ORACLE = """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n"""
