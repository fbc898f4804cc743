"""Mixing sources to target weights: iterative proportional fitting and calibrated sampling, in DataFrame functions only.

Tokens are summed by cell (source, language, topic). Sweeps of proportional fitting rake the cells' weights until
their sums meet the target of every source, language and topic at once. The ratio of raked to present weight,
scaled to the token budget and capped at 1 (what saturated cells cannot give is spread over the others), is the
chance with which a document of the cell is kept; the draw is a hash of its id, so it never depends on
partitioning and a rerun keeps the same documents.

Documents are read for the sums and for the draw; they are never shuffled. Cells are few: they are pre-aggregated,
and only up to ``ONE_TASK_CELLS`` of them are raked within one task; more are raked by shuffles on the same code.

Cases: a null source or language is a category of its own; null and empty texts hold no tokens and are of topic
``empty``; a cell without tokens keeps all its documents (they cost nothing); rows of one id share one draw, also
null ids; an empty table gives an empty result; other columns are carried along and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import store

#: Share of all tokens to keep, and how far each marginal is flattened: target share ~ present share ** power.
BUDGET = 0.5
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
MAX_SWEEPS, SWEEPS_AT_ONCE, TOLERANCE = 60, 6, 1e-10
ONE_TASK_CELLS = 100_000
NONE = "(none)"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\r\n]+")), F.lit(0)).cast("long")


def topic(text: Column, n: Column) -> Column:
    """A topic by the form of the text; callers with topics of their own pass another column."""
    def marks(c: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))

    return (
        F.when(n == 0, "empty").when(marks("|") * 3 > n, "table").when(marks("!!") > n, "calls")
        .when(marks("$$$") + marks("%%%") > n, "symbols").when(n < 150, "brief").when(n < 1500, "article").otherwise("long")
    )


def _keys(docs: DataFrame, topic_of) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    n = token_count(text)
    return docs.select(
        F.struct(*docs.columns).alias("row"), F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"), topic_of(text, n).alias("topic"), n.alias("n"),
    )


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, powers: dict[str, float] = POWERS) -> DataFrame:
    """cells (source, lang, topic, tokens) with ``mass``: shares of 1 whose marginals meet the targets.

    ``targets``: for any of the three dimensions a table (category, share); others flatten the present shares by
    ``powers``. Stops when the largest change of a sweep is below TOLERANCE, or after MAX_SWEEPS.
    """
    dims = list(powers)
    cells = cells.where("tokens > 0")
    whole = cells.agg(F.sum("tokens").alias("all_tokens"))
    for d in dims:
        part = cells.groupBy(d).agg(F.sum("tokens").alias("t"))
        if targets and d in targets:
            goal = part.join(targets[d].select(F.col("category").alias(d), F.col("share").cast("double").alias("g")), d).where("g > 0")
        else:
            goal = part.crossJoin(whole).select(d, F.pow(F.col("t") / F.col("all_tokens"), F.lit(powers[d])).alias("g"))  # one row on the right
        goal = goal.crossJoin(goal.agg(F.sum("g").alias("sum_g"))).select(d, (F.col("g") / F.col("sum_g")).alias(f"goal_{d}"))
        cells = cells.join(goal, d)
    mass = store(cells.crossJoin(whole).select(*dims, "tokens", *(f"goal_{d}" for d in dims), (F.col("tokens") / F.col("all_tokens")).alias("mass")), "cells")
    n = mass.count()
    for _ in range(0, MAX_SWEEPS, SWEEPS_AT_ONCE):
        if n <= ONE_TASK_CELLS:
            mass = mass.coalesce(1)
        for sweep in range(SWEEPS_AT_ONCE):
            if sweep == SWEEPS_AT_ONCE - 1:
                mass = mass.withColumn("before", F.col("mass"))
            for d in dims:
                mass = mass.withColumn("mass", F.col("mass") * F.col(f"goal_{d}") / F.sum("mass").over(Window.partitionBy(d)))
        mass = store(mass.withColumn("moved", F.abs(F.col("mass") - F.col("before"))).drop("before"), "raked")
        moved = mass.agg(F.max("moved")).first()[0]
        mass = mass.drop("moved")
        if moved is None or moved < TOLERANCE:
            break
    return mass.select(*dims, "tokens", "mass")


def probabilities(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """raked cells with ``weight`` (raked over present share) and ``p``, scaled so that the expected tokens meet the budget.

    In falling order of weight, the first j cells are taken whole (p = 1) for the smallest j at which the rest of
    the budget can be spread over the other cells in proportion to their weights.
    """
    w = raked.withColumn("weight", F.col("mass") / F.col("tokens")).coalesce(1)
    order = Window.orderBy(F.desc("weight"), "source", "lang", "topic")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumns({
        "whole": F.coalesce(F.sum("tokens").over(before), F.lit(0)),
        "rest": F.greatest(F.lit(1e-300), 1 - F.coalesce(F.sum("mass").over(before), F.lit(0.0))),
    }).withColumn("all_tokens", F.sum("tokens").over(Window.partitionBy()))
    w = w.withColumn("scale", (F.col("all_tokens") * budget - F.col("whole")) / F.col("rest"))
    w = w.withColumn("fits", F.col("scale") * F.col("weight") <= 1)
    w = w.withColumn("k", F.max_by("scale", F.when(F.col("fits"), F.col("weight"))).over(Window.partitionBy()))
    p = F.when(F.col("k").isNull(), 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("k") * F.col("weight"))))
    return w.select("source", "lang", "topic", (F.col("weight") * F.col("all_tokens")).alias("weight"), p.alias("p"))


def draw(doc_id: Column, seed: int) -> Column:
    """Uniform in [0, 1) from the first 48 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit(NONE)), F.lit(f":{seed}"))), 1, 12), 16, 10).cast("double") / float(1 << 48)


def mix(docs: DataFrame, budget: float = BUDGET, targets: dict[str, DataFrame] | None = None, seed: int = 3, topic_of=topic) -> DataFrame:
    """row (all columns of docs), source, lang, topic, n, weight, p and kept for every document."""
    keyed = _keys(docs, topic_of)
    cells = keyed.groupBy("source", "lang", "topic").agg(F.sum("n").alias("tokens"))
    chances = store(probabilities(rake(cells, targets), budget), "chances")
    out = keyed.join(chances, ["source", "lang", "topic"], "left")
    p = F.when(F.col("n") == 0, 1.0).otherwise(F.coalesce("p", F.lit(0.0)))
    return out.select("row", "source", "lang", "topic", "n", "weight", p.alias("p")).withColumn("kept", draw(F.col("row.doc_id"), seed) < F.col("p"))


def sample(docs: DataFrame, budget: float = BUDGET, targets: dict[str, DataFrame] | None = None, seed: int = 3) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they are."""
    return mix(docs, budget, targets, seed).where("kept").select("row.*")


_GOAL = "WITH_{d} AS (SELECT {d}, g / sum(g) OVER () AS goal_{d} FROM (SELECT {d}, pow(sum(tokens) / (SELECT sum(tokens) FROM cells), {power}) AS g FROM cells WHERE tokens > 0 GROUP BY {d}))"
_MARKS = "(length(text) - length(replace(text, '{c}', '')))"
ORACLE_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang FROM documents),
counted AS (SELECT *, len(regexp_extract_all(text, '[^ \\t\\r\\n]+'))::BIGINT AS n FROM docs),
keyed AS (SELECT doc_id, source, lang, n, CASE WHEN n = 0 THEN 'empty' WHEN {_MARKS.format(c='|')} * 3 > n THEN 'table' WHEN {_MARKS.format(c='!!')} > n THEN 'calls'
  WHEN {_MARKS.format(c='$$$')} + {_MARKS.format(c='%%%')} > n THEN 'symbols' WHEN n < 150 THEN 'brief' WHEN n < 1500 THEN 'article' ELSE 'long' END AS topic FROM counted),
cells AS (SELECT source, lang, topic, sum(n)::DOUBLE AS tokens FROM keyed GROUP BY ALL),
{', '.join(_GOAL.format(d=d, power=p) for d, p in POWERS.items())},
ipf AS (
  SELECT 0 AS it, source, lang, topic, tokens, goal_source, goal_lang, goal_topic, tokens / sum(tokens) OVER () AS mass
  FROM cells JOIN WITH_source USING (source) JOIN WITH_lang USING (lang) JOIN WITH_topic USING (topic) WHERE tokens > 0
  UNION ALL
  SELECT it + 1, source, lang, topic, tokens, goal_source, goal_lang, goal_topic, m2 * goal_topic / sum(m2) OVER (PARTITION BY topic) FROM (
    SELECT *, m1 * goal_lang / sum(m1) OVER (PARTITION BY lang) AS m2 FROM (
      SELECT *, mass * goal_source / sum(mass) OVER (PARTITION BY source) AS m1 FROM ipf WHERE it < {MAX_SWEEPS}))),
w AS (SELECT source, lang, topic, tokens, mass, mass / tokens AS weight FROM ipf WHERE it = {MAX_SWEEPS}),
o AS (SELECT *, coalesce(sum(tokens) OVER b, 0) AS whole, greatest(1e-300, 1 - coalesce(sum(mass) OVER b, 0)) AS rest, sum(tokens) OVER () AS all_tokens
  FROM w WINDOW b AS (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, (all_tokens * {BUDGET} - whole) / rest AS scale FROM o),
k AS (SELECT *, (SELECT arg_max(scale, weight) FROM s WHERE scale * weight <= 1) AS k FROM s),
chances AS (SELECT source, lang, topic, weight * all_tokens AS weight, CASE WHEN k IS NULL THEN 1.0 ELSE least(1.0, greatest(0.0, k * weight)) END AS p FROM k)
SELECT doc_id, source, lang, topic, n AS tokens, round(weight, 5) AS weight, round(CASE WHEN n = 0 THEN 1.0 ELSE coalesce(p, 0.0) END, 5) AS p,
  (('0x' || substr(md5(doc_id || ':3'), 1, 12))::BIGINT / {float(1 << 48)!r}) < CASE WHEN n = 0 THEN 1.0 ELSE coalesce(p, 0.0) END AS kept
FROM keyed LEFT JOIN chances USING (source, lang, topic)
"""
