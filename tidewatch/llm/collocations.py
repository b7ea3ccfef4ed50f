"""Phrase collocation mining with set-oriented relational steps (SETM).

An occurrence relation ``R_k`` holds the places (piece, position) where a
frequent phrase of ``k`` words starts, sorted by place and kept in blocks of
whole pieces in the shared folder.  One step

1. joins ``R_k`` with itself by piece and adjacent position: a merge of sorted
   places inside a block (places of different pieces are never adjacent).  Two
   phrases that overlap in all but one word make a phrase of ``k + 1`` words;
2. counts the groups: a block sends each of its distinct pairs once, with its
   number of occurrences, and Spark adds them up;
3. keeps each block's rows of the groups with enough occurrences (where the
   groups are counted, so the semi-join costs no further shuffle), as the table
   ``items`` of phrases and, block by block, as what the next step extends.

Phrases are counted by language.  A word's number is its row in ``items`` of
step one, a longer phrase is the pair of its prefix and suffix, so keys are
exact and short however long the words are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import discard, slices, table, written

LEAST, LONGEST, TOP = 30, 4, 2000
#: A phrase goes if a longer one has at least this share of its occurrences, in per cent.
COVERED, SCALE = 80, 2_000_000
BLOCK_WORDS, ROWS = 3_000_000, 256

BLOCKS = "block long, langs array<string>, tokens array<long>, lang binary, words binary, counts binary, place binary, item binary"
WORDS = "block long, code int, lang string, word string, n long"
OCCURRENCES = "block long, place binary, kinds binary, item binary"
PAIRS = "block long, prefix long, suffix long, n long"

#: A-Z lower-cased, the ends of pieces (. , ; : ! ? and U+000A to U+000D) as one byte.
_PIECES = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x0A if b in b".,;:!?\x0a\x0b\x0c\x0d" else b
                for b in range(256))


def _pack(x, kind: str) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, kind).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*(x.split() for x in schema.split(", ")))
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, pa.Array) else pa.array(x, kinds[t]) for x, t in zip(columns, types)],
        names=list(names))


def pieces(text: str | None) -> list[list[bytes]]:
    """Words of each piece of a text."""
    data = (text or "").encode("utf-8", "replace").translate(_PIECES)
    return [found for p in data.split(b"\n") if (found := p.split())]


def blocks_of(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All word occurrences in blocks of whole pieces (see BLOCKS): places, and
    the number of each word in the block's own word list; written once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        known: dict[str, dict[bytes, int]] = {}
        words: list[bytes] = []
        of: list[int] = []              # language of each word
        tokens: list[int] = []
        ids: list[int] = []
        sizes: list[int] = []           # of pieces

        def block() -> pa.RecordBatch:
            item = np.array(ids, "<u4")
            place = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)
            return _batch([[part + made], [list(known)], [tokens], [_pack(of, "<u4")],
                           [b"\n".join(words)],  # words hold no line ends
                           [_pack(np.bincount(item, minlength=len(words)), "<u4")],
                           [_pack(np.diff(place, prepend=0), "<u1")], [_pack(item, "<u4")]], BLOCKS)

        for b in slices(batches, ROWS):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if lang not in known:
                    known[lang] = {}
                    tokens.append(0)
                own, at = known[lang], list(known).index(lang)
                for found in pieces(text):
                    for w in found:
                        if w not in own:
                            own[w] = len(words)
                            words.append(w)
                            of.append(at)
                    ids.extend(map(own.__getitem__, found))
                    sizes.append(len(found))
                    tokens[at] += len(found)
                    if len(ids) >= block_words:
                        yield block()
                        made += 1
                        known, words, of, tokens, ids, sizes = {lang: {}}, [], [], [0], [], []
                        own, at = known[lang], 0
        if ids:
            yield block()

    return written(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                               "text").mapInArrow(run, BLOCKS), "setm-blocks")


def block_words(blocks: DataFrame) -> DataFrame:
    """The words of each block with their occurrences in it (see WORDS)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            block, langs, lang, words, counts = (c.to_pylist()[0] for c in b.columns)
            words = pa.array(words.split(b"\n"), pa.binary()).cast(pa.string())
            yield _batch([np.full(len(words), block), np.arange(len(words), dtype=np.int32),
                          pa.array(langs, pa.string()).take(pa.array(_unpack(lang, "<u4"))),
                          words, _unpack(counts, "<u4").astype(np.int64)], WORDS)

    return blocks.select("block", "langs", "lang", "words", "counts").mapInArrow(run, WORDS)


def _occurrences(block: int, place: np.ndarray, item: np.ndarray) -> pa.Table:
    """One row of an occurrence relation; ``item`` are numbers of ``items`` rows."""
    kinds, codes = np.unique(item, return_inverse=True)
    row = [[block], [_pack(np.diff(place, prepend=0), "<u4")], [_pack(kinds, "<i8")],
           [_pack(codes, "<u4")]] if len(item) else [[], [], [], []]
    return pa.Table.from_batches([_batch(row, OCCURRENCES)])


def frequent_words_in(blocks: DataFrame, kept: DataFrame) -> DataFrame:
    """``R_1``: occurrences of the words whose ``block``, ``code``, ``id`` are ``kept``."""
    def run(known: pa.Table, rows: pa.Table) -> pa.Table:
        if not rows.num_rows or not known.num_rows:
            return _occurrences(0, np.zeros(0, np.int64), np.zeros(0, np.int64))
        place = np.cumsum(_unpack(rows["place"][0].as_py(), "<u1"), dtype=np.int64)
        code = _unpack(rows["item"][0].as_py(), "<u4")
        number = np.full(int(code.max()) + 1, -1, np.int64)
        number[known["code"].to_numpy()] = known["id"].to_numpy()
        item = number[code]
        return _occurrences(rows["block"][0].as_py(), place[item >= 0], item[item >= 0])

    return written(kept.groupBy("block").cogroup(
        blocks.select("block", "place", "item").groupBy("block")).applyInArrow(run, OCCURRENCES),
        "setm-occurrences")


def _adjacent(place: bytes, item: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and codes; ``first`` are the rows whose next row is one place on."""
    return (np.flatnonzero(_unpack(place, "<u4")[1:] == 1), _unpack(item, "<u4"))


def adjacent_pairs(occurrences: DataFrame) -> DataFrame:
    """Distinct adjacent pairs of each block with their occurrences (see PAIRS)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            block, place, kinds, item = (c.to_pylist()[0] for c in b.columns)
            kinds = _unpack(kinds, "<i8")
            first, code = _adjacent(place, item)
            pairs, n = np.unique(code[first] * np.int64(len(kinds)) + code[first + 1],
                                 return_counts=True)
            yield _batch([np.full(len(n), block), kinds[pairs // len(kinds)],
                          kinds[pairs % len(kinds)], n], PAIRS)

    return occurrences.mapInArrow(run, PAIRS)


def extended(occurrences: DataFrame, kept: DataFrame) -> DataFrame:
    """``R_(k+1)``: adjacent occurrences of ``R_k`` whose pair (``block``,
    ``prefix``, ``suffix``, ``id``) is ``kept``."""
    def run(known: pa.Table, rows: pa.Table) -> pa.Table:
        if not rows.num_rows or not known.num_rows:
            return _occurrences(0, np.zeros(0, np.int64), np.zeros(0, np.int64))
        kinds = _unpack(rows["kinds"][0].as_py(), "<i8")
        at = np.cumsum(_unpack(rows["place"][0].as_py(), "<u4"), dtype=np.int64)
        first, code = _adjacent(rows["place"][0].as_py(), rows["item"][0].as_py())
        pair = code[first] * np.int64(len(kinds)) + code[first + 1]
        asked = (np.searchsorted(kinds, known["prefix"].to_numpy()) * len(kinds)
                 + np.searchsorted(kinds, known["suffix"].to_numpy()))
        order = np.argsort(asked)
        asked, ids = asked[order], known["id"].to_numpy()[order]
        found = np.minimum(np.searchsorted(asked, pair), len(asked) - 1)
        hit = asked[found] == pair
        return _occurrences(rows["block"][0].as_py(), at[first[hit]], ids[found[hit]])

    return written(kept.groupBy("block").cogroup(occurrences.groupBy("block")).applyInArrow(
        run, OCCURRENCES), "setm-occurrences")


def _frequent(rows: DataFrame, keys: list[str], least: int, name: str) -> DataFrame:
    """The ``rows`` (``n`` occurrences of a group in a block) of groups with at least
    ``least`` occurrences ``a``, with a number ``id`` for each group; written once.

    The rows meet in one shuffle, where each group has a row per block; a join
    with the counted groups would send them all a second time."""
    group = Window.partitionBy(*keys)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.monotonically_increasing_id()  # partition and place, as one small number
    number = row.bitwiseAND((1 << 33) - 1) * parts + F.shiftright(row, 33)
    return written(rows.repartition(*keys).withColumn("_row", number)
                   .withColumn("a", F.sum("n").over(group)).where(F.col("a") >= least)
                   .withColumn("id", F.min("_row").over(group)).drop("_row", "n"), name)


def phrase_levels(docs: DataFrame, least: int = LEAST, longest: int = LONGEST,
                  block_size: int = BLOCK_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the phrases of 1, 2, ... ``longest`` words with at least
    ``least`` occurrences, and the words ``n`` of each language.

    Every level has ``id``, ``lang``, ``phrase``, ``last`` (its last word), ``a``
    (occurrences) and, by number of words, those of its beginnings ``heads`` and
    ends ``tails`` (the whole phrase last)."""
    blocks = blocks_of(docs, block_size)
    sizes = (blocks.select(F.explode(F.arrays_zip(F.col("langs").alias("lang"),
                                                  F.col("tokens").alias("n"))).alias("x"))
             .groupBy(F.col("x.lang").alias("lang")).agg(F.sum("x.n").alias("n")))
    sizes = written(sizes, "setm-sizes")
    kept = _frequent(block_words(blocks), ["lang", "word"], least, "setm-words")
    a = F.array("a")
    items = written(kept.groupBy("id").agg(F.first("lang").alias("lang"),
                                           F.first("word").alias("phrase"), F.first("a").alias("a"))
                    .select("id", "lang", "phrase", F.col("phrase").alias("last"), "a",
                            a.alias("heads"), a.alias("tails")), "setm-items")
    levels, occurrences = [items], None
    for _ in range(1, longest):
        if occurrences is None:
            occurrences = frequent_words_in(blocks, kept.select("block", "code", "id"))
            discard(blocks, kept)
        else:
            shorter, occurrences = occurrences, extended(occurrences, kept.drop("a"))
            discard(shorter, kept)
        kept = _frequent(adjacent_pairs(occurrences), ["prefix", "suffix"], least, "setm-pairs")
        found = kept.groupBy("id").agg(*[F.first(c).alias(c) for c in ("prefix", "suffix", "a")])
        begin, end = items.alias("p"), items.alias("s")
        a = F.array(F.col("f.a"))
        items = written(
            found.alias("f").join(begin, F.col("f.prefix") == F.col("p.id"))
            .join(end, F.col("f.suffix") == F.col("s.id"))
            .select("f.id", "f.prefix", "f.suffix", "p.lang",
                    F.concat_ws(" ", "p.phrase", "s.last").alias("phrase"), "s.last", "f.a",
                    F.concat("p.heads", a).alias("heads"), F.concat("s.tails", a).alias("tails")),
            "setm-items")
        levels.append(items)
    return levels, sizes


def _lowest_cut(words: int) -> Column:
    """The lowest score over the cuts of a phrase, then the smallest cut."""
    def cut(k: int) -> Column:
        l, r = (F.col(side).getItem(i) for side, i in (("heads", k - 1), ("tails", words - k - 1)))
        # more than 64 bits: a * SCALE, and l + r
        score = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div "
                       f"(cast(heads[{k - 1}] as decimal(20,0)) + tails[{words - k - 1}])")
        return F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), l.alias("l"),
                        r.alias("r"))

    return F.array_min(F.array(*[cut(k) for k in range(1, words)]))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST,
                 covered: int = COVERED, top: int | None = TOP,
                 block_size: int = BLOCK_WORDS) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of every language: ``lang``,
    ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``; all with ``top=None``.

    * a null text counts as empty and gives nothing; a null ``lang`` is ``und``
      and joins the rows that say so; an empty language name is one of its own;
    * repeated rows count as often as they stand; no other column is read;
    * equal scores: more occurrences first, then the phrase by its bytes;
    * very long texts are cut into blocks between pieces; a block holds at
      least one whole piece;
    * an empty table, or one without frequent phrases, gives no rows.
    """
    levels, sizes = phrase_levels(docs, least, longest, block_size)
    out = None
    for words, level in enumerate(levels[1:], 2):
        rows = level.withColumn("_cut", _lowest_cut(words))
        if words < longest:
            longer = levels[words]  # a phrase inside a longer one is inside one of one word more
            most = (longer.select(F.col("prefix").alias("_id"), "a").union(longer.select("suffix", "a"))
                    .groupBy("_id").agg(F.max("a").alias("_most")))
            rows = rows.join(most, F.col("id") == F.col("_id"), "left").where(
                F.expr(f"_most is null or cast(_most as decimal(20,0)) * 100 < "
                       f"cast(a as decimal(20,0)) * {covered}"))
        rows = rows.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
        out = rows if out is None else out.unionByName(rows)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(best).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """Counts of all phrases from the word list of each piece."""
    def phrases(k: int) -> str:
        return (f"c{k} AS MATERIALIZED (SELECT lang, phrase, count(*) AS a FROM ("
                f"SELECT lang, unnest(list_transform(range(1, len(words) - {k - 2}), "
                f"lambda i: array_to_string(words[i:i + {k - 1}], ' '))) AS phrase FROM found) "
                f"GROUP BY ALL HAVING count(*) >= {LEAST})")  # parts are as frequent as the whole

    def cuts(k: int) -> str:
        out = []
        for cut in range(1, k):
            head = f"array_to_string(string_split(f.phrase, ' ')[:{cut}], ' ')"
            tail = f"array_to_string(string_split(f.phrase, ' ')[{cut + 1}:], ' ')"
            out.append(f"""
  SELECT f.lang, f.phrase, f.a, {k} AS words, {cut} AS k, h.a AS l, t.a AS r,
         (CAST(f.a AS HUGEINT) * {SCALE}) // (h.a + t.a) AS score
  FROM c{k} f JOIN c{cut} h ON h.lang = f.lang AND h.phrase = {head}
  JOIN c{k - cut} t ON t.lang = f.lang AND t.phrase = {tail}""")
        return " UNION ALL ".join(out)

    inner = " UNION ALL ".join(
        f"""SELECT lang, array_to_string(string_split(phrase, ' ')[{i}:{i + short - 1}], ' ') AS phrase, a
  FROM c{k}""" for k in range(3, LONGEST + 1) for short in range(2, k)
        for i in range(1, k - short + 2))
    return f"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
found AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
n AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM found GROUP BY lang),
{", ".join(phrases(k) for k in range(1, LONGEST + 1))},
cut AS ({" UNION ALL ".join(cuts(k) for k in range(2, LONGEST + 1))}),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_most AS (SELECT lang, phrase, max(a) AS most FROM ({inner}) GROUP BY ALL),
kept AS (SELECT l.* FROM lowest l LEFT JOIN inner_most m USING (lang, phrase)
         WHERE m.most IS NULL OR 100 * m.most < {COVERED} * l.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= {TOP}"""
