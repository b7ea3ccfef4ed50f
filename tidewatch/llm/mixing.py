"""Mixing sources to target weights by iterative proportional fitting (DataFrame functions only).

Token counts per (source, language, topic) cell are raked until the token
shares of every source, language and topic meet their targets.  The targets
temper the shares of the corpus: ``share ** exponent``, normalised, so large
groups shrink and small ones grow.  Documents are then sampled: a document's
probability is ``min(1, scale * weight)`` of its cell, and the scale is
calibrated so that the expected tokens meet the budget.

Targets of three marginals need not be compatible: a source of one language
only cannot follow both targets.  Raking therefore goes on until the factors
settle or a round no longer shrinks the largest miss, sources are met last,
and what the languages and topics still miss is part of the result
(``lang_miss``, ``topic_miss``: share of the tokens minus target share).

Sources may be unbounded in number, so a source is one distributed row that
holds its (language, topic) cells; a raking round adjusts all sources row by
row and needs one small aggregation.  Only the (language, topic) totals reach
the driver; ``MAX_PAIRS`` bounds them and more is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WS, table, text_or_empty, written

#: Exponents that temper the shares of sources, languages and topics.
EXPONENTS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
#: Expected tokens of the sample as a share of the corpus.
BUDGET = 0.8
#: Topics by the first pattern found in the text, else "prose".
TOPICS = (("license", "(?i)licen[sc]ed? under|all rights reserved|copyright"),
          ("contact", r"\w@\w+\.\w"),
          ("table", r" \| "))
SEED = "mix-1"
#: Raking ends when no factor changes by more than ``TOLERANCE``, or when a round takes
#: less than the share ``GAIN`` off the largest miss (the targets cannot all be met).
MAX_PAIRS, TOLERANCE, GAIN = 4096, 1e-11, 0.01
CELL, MISSES = ["source", "lang", "topic"], ["lang_miss", "topic_miss"]


def topic_of(text: Column, topics=TOPICS) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(topics):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def with_cell(docs: DataFrame, topics=TOPICS) -> DataFrame:
    """``docs`` as ``_doc`` with its cell; a null source or language is the empty one."""
    return docs.select(
        F.struct("*").alias("_doc"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source"),
        F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("lang"),
        topic_of(text_or_empty(), topics).alias("topic"))


def features(docs: DataFrame, topics=TOPICS) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, ``topic``, ``n_tokens`` (words) of every row."""
    return with_cell(docs.select("doc_id", "source", "lang", "text"), topics).select(
        F.col("_doc.doc_id").cast("long").alias("doc_id"), *CELL,
        F.regexp_count(F.coalesce("_doc.text", F.lit("")), F.lit(f"[^{WS}]+")).cast("long")
        .alias("n_tokens"))


def _targets(totals: dict, exponent: float) -> dict:
    parts = {k: v ** exponent if v else 0.0 for k, v in totals.items()}
    return {k: sum(totals.values()) * p / sum(parts.values()) for k, p in parts.items()}


def rake(cells: DataFrame, exponents: dict = EXPONENTS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``: the factor by which
    a cell's tokens are multiplied so that all three marginals meet their targets,
    and with ``lang_miss`` and ``topic_miss``, the share that the cell's language and
    topic have under these weights minus their target share: zero where the
    targets are met.  Sources are met always.

    A source, language or topic without any token has factor one and misses nothing.
    """
    spark = cells.sparkSession
    pairs = cells.groupBy("lang", "topic").agg(F.sum("tokens").alias("tokens")).orderBy(
        "lang", "topic").limit(MAX_PAIRS + 1).collect()
    if len(pairs) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} (language, topic) pairs")
    total = sum(p.tokens for p in pairs)
    if not total:
        return cells.select("*", F.lit(1.0).alias("weight"), F.lit(0.0).alias("lang_miss"),
                            F.lit(0.0).alias("topic_miss"))
    goal = {}
    for dim in ("lang", "topic"):
        sums: dict = {}
        for p in pairs:
            sums[p[dim]] = sums.get(p[dim], 0) + p.tokens
        goal[dim] = _targets(sums, exponents[dim])
    number = F.broadcast(spark.createDataFrame(  # at most MAX_PAIRS rows
        [(p.lang, p.topic, i) for i, p in enumerate(pairs)], "lang string, topic string, pair int"))
    sources = written(
        cells.join(number, ["lang", "topic"]).groupBy("source").agg(
            F.collect_list(F.struct("pair", "tokens")).alias("cells"),  # at most MAX_PAIRS
            F.sum("tokens").alias("tokens")), "mix-sources")
    power = exponents["source"]
    norm = sources.agg(F.sum(F.pow("tokens", F.lit(power)))).first()[0]

    def source_factor(factors: list[float]) -> Column:
        now = F.aggregate("cells", F.lit(0.0), lambda x, c: x + c["tokens"] * F.get(
            F.lit(factors), c["pair"]))
        return F.coalesce(F.pow("tokens", F.lit(power)) * F.lit(total / norm)
                          / F.nullif(now, F.lit(0.0)), F.lit(1.0))

    b = dict.fromkeys(goal["lang"], 1.0)
    c = dict.fromkeys(goal["topic"], 1.0)
    misses: list[float] = []
    while True:
        factors = [b[p.lang] * c[p.topic] for p in pairs]
        rows = (sources.select(source_factor(factors).alias("a"), F.explode("cells").alias("cell"))
                .groupBy("cell.pair").agg(F.sum(F.col("a") * F.col("cell.tokens")).alias("n"))
                .collect())
        seen = {r.pair: r.n for r in rows}  # without the factors of language and topic
        miss = {dim: dict.fromkeys(goal[dim], 0.0) for dim in goal}
        for i, p in enumerate(pairs):
            for dim in miss:
                miss[dim][p[dim]] += seen.get(i, 0.0) * factors[i] / total
        miss = {dim: {k: v - goal[dim][k] / total for k, v in its.items()}
                for dim, its in miss.items()}
        misses.append(max(abs(v) for its in miss.values() for v in its.values()))
        if misses[-1] < TOLERANCE or _stalled(misses):
            break
        change = 0.0
        for dim, mine, other, its in (("lang", b, "topic", c), ("topic", c, "lang", b)):
            now = dict.fromkeys(mine, 0.0)
            for i, p in enumerate(pairs):
                now[p[dim]] += seen.get(i, 0.0) * its[p[other]]
            for k in mine:
                new = goal[dim][k] / now[k] if now[k] else 1.0
                change = max(change, abs(new / mine[k] - 1) if mine[k] else abs(new))
                mine[k] = new
        if change < TOLERANCE:
            break
    missed = F.broadcast(spark.createDataFrame(  # at most MAX_PAIRS rows
        [(p.lang, p.topic, i, miss["lang"][p.lang], miss["topic"][p.topic])
         for i, p in enumerate(pairs)],
        "lang string, topic string, pair int, lang_miss double, topic_miss double"))
    return (sources.select("source", source_factor(factors).alias("a"),
                           F.explode("cells").alias("cell"))
            .select("source", F.col("cell.pair").alias("pair"), F.col("cell.tokens").alias("tokens"),
                    (F.col("a") * F.get(F.lit(factors), F.col("cell.pair"))).alias("weight"))
            .join(missed, "pair").select(*CELL, "tokens", "weight", "lang_miss", "topic_miss"))


def _stalled(misses: list[float], over: int = 10) -> bool:
    """The last rounds together shrank the largest miss by less than ``GAIN`` a round."""
    return len(misses) > over and misses[-1] > misses[-1 - over] * (1 - GAIN) ** over


def calibrated(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``cells`` with ``probability = min(1, scale * weight)``; the scale is raised
    until the expected tokens meet ``budget`` times all tokens (or all cells are at one)."""
    at = F.col("tokens") * F.col("weight")
    scale, before = 0.0, -1
    while True:  # a round puts at least one more cell at one, so this ends
        capped = F.col("weight") * F.lit(scale) >= 1
        r = cells.agg(F.sum(F.when(capped, F.col("tokens")).otherwise(0)).alias("full"),
                      F.sum(F.when(capped, 0.0).otherwise(at)).alias("part"),
                      F.sum("tokens").alias("all")).first()
        goal = budget * (r["all"] or 0)
        if not r["part"] or goal <= r["full"] or r["full"] == before:
            break
        before, scale = r["full"], (goal - r["full"]) / r["part"]
    if not goal:  # no token at all
        return cells.withColumn("probability", F.lit(1.0))
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))


def cell_probabilities(rows: DataFrame, exponents: dict = EXPONENTS,
                       budget: float = BUDGET) -> DataFrame:
    """Weight and probability of every cell of ``features`` rows."""
    cells = written(rows.groupBy(*CELL).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    raked = written(rake(cells, exponents), "mix-raked")
    return written(calibrated(raked, budget).select(
        *CELL, F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"),
        *[F.when(F.abs(m) >= 5e-7, F.round(m, 6)).otherwise(0.0).alias(m) for m in MISSES]),
        "mix-probabilities")


def drawn(doc_id: Column, seed: str = SEED) -> Column:
    """A uniform number in [0, 1) that depends on the document only."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(2.0 ** 52)


def mix(docs: DataFrame, topics=TOPICS, exponents: dict = EXPONENTS, budget: float = BUDGET,
        seed: str = SEED) -> DataFrame:
    """One row per input row: ``doc_id``, its cell, ``n_tokens``, ``weight``,
    ``probability``, ``lang_miss``, ``topic_miss`` and ``sampled``.

    * targets that cannot all be met are met as far as raking comes, the sources
      exactly; the two misses say what is left (:func:`rake`), 0 where targets are met;
    * a null text has no tokens and topic "prose"; null sources and languages
      are the empty ones;
    * documents are drawn by a hash of ``doc_id``, so repeated rows are drawn
      together and a rerun draws the same; a null ``doc_id`` counts as empty;
    * other columns are not read; an empty table gives no rows.
    """
    rows = written(features(docs, topics), "mix-features")
    cells = cell_probabilities(rows, exponents, budget)
    return rows.join(cells, CELL).select(
        "doc_id", *CELL, "n_tokens", "weight", "probability", *MISSES,
        (drawn(F.col("doc_id"), seed) < F.col("probability")).alias("sampled"))


def sampled(docs: DataFrame, topics=TOPICS, exponents: dict = EXPONENTS, budget: float = BUDGET,
            seed: str = SEED) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns; a row is drawn where it
    lies, by the probability of its cell."""
    cells = cell_probabilities(written(features(docs, topics), "mix-features"), exponents, budget)
    return (with_cell(docs, topics).join(cells, CELL)
            .filter(drawn(F.col("_doc.doc_id"), seed) < F.col("probability")).select("_doc.*"))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def oracle(rounds: int = 25, caps: int = 12) -> str:
    """The same fit as a chain of SQL steps."""
    rules = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS)
    steps = [f"""
d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE {rules} ELSE 'prose' END AS topic,
         CAST(len(regexp_extract_all(t, '[^{WS}]+')) AS BIGINT) AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
k AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS n
                   FROM d GROUP BY ALL)"""]
    for dim, power in EXPONENTS.items():
        steps.append(f"""
g_{dim} AS MATERIALIZED (
  SELECT {dim}, power(n, {power}) * sum(n) OVER () / sum(power(n, {power})) OVER () AS goal
  FROM (SELECT {dim}, sum(n) AS n FROM k GROUP BY 1))""")
    for r in range(rounds + 1):
        for dim in CELL:
            if r == 0:
                if dim != "source":
                    steps.append(f"\nf_{dim}_0 AS (SELECT {dim}, 1.0::DOUBLE AS f FROM g_{dim})")
                continue
            others = [x for x in CELL if x != dim]
            now = {x: r if CELL.index(x) < CELL.index(dim) else r - 1 for x in others}
            steps.append(f"""
f_{dim}_{r} AS MATERIALIZED (
  SELECT {dim}, coalesce(any_value(goal) / nullif(sum(k.n * x.f * y.f), 0), 1) AS f
  FROM k JOIN f_{others[0]}_{now[others[0]]} x USING ({others[0]})
         JOIN f_{others[1]}_{now[others[1]]} y USING ({others[1]})
         JOIN g_{dim} USING ({dim}) GROUP BY 1)""")
    # sources are raked first in every round, and once more at the end
    r = rounds + 1
    steps.append(f"""
f_source_{r} AS MATERIALIZED (
  SELECT source, coalesce(any_value(goal) / nullif(sum(k.n * x.f * y.f), 0), 1) AS f
  FROM k JOIN f_lang_{rounds} x USING (lang) JOIN f_topic_{rounds} y USING (topic)
         JOIN g_source USING (source) GROUP BY 1),
w AS MATERIALIZED (
  SELECT source, lang, topic, n, s.f * x.f * y.f AS w
  FROM k JOIN f_source_{r} s USING (source) JOIN f_lang_{rounds} x USING (lang)
         JOIN f_topic_{rounds} y USING (topic)),
m_lang AS (SELECT lang, coalesce((sum(n * w) - any_value(goal)) / nullif(sum(sum(n)) OVER (), 0), 0)
             AS lang_miss FROM w JOIN g_lang USING (lang) GROUP BY 1),
m_topic AS (SELECT topic, coalesce((sum(n * w) - any_value(goal)) / nullif(sum(sum(n)) OVER (), 0), 0)
              AS topic_miss FROM w JOIN g_topic USING (topic) GROUP BY 1),
s_0 AS (SELECT 0.0::DOUBLE AS s)""")
    for i in range(1, caps + 1):
        steps.append(f"""
s_{i} AS MATERIALIZED (
  SELECT CASE WHEN part > 0 AND goal > whole THEN (goal - whole) / part ELSE s END AS s FROM (
    SELECT any_value(s) AS s, {BUDGET} * sum(n) AS goal,
           sum(CASE WHEN w * s >= 1 THEN n ELSE 0 END) AS whole,
           sum(CASE WHEN w * s >= 1 THEN 0 ELSE n * w END) AS part
    FROM w CROSS JOIN s_{i - 1}))""")
    return "WITH " + ",".join(steps) + f"""
SELECT doc_id, source, lang, topic, n_tokens, weight, probability,
       CASE WHEN abs(lang_miss) >= 5e-7 THEN round(lang_miss, 6) ELSE 0 END AS lang_miss,
       CASE WHEN abs(topic_miss) >= 5e-7 THEN round(topic_miss, 6) ELSE 0 END AS topic_miss,
       ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE
         / 4503599627370496 < probability AS sampled
FROM d JOIN (SELECT source, lang, topic, round(w, 6) AS weight,
                    round(least(1, w * s), 6) AS probability
             FROM w CROSS JOIN s_{caps}) USING (source, lang, topic)
JOIN m_lang USING (lang) JOIN m_topic USING (topic)"""
