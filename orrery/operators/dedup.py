"""Deduplication as combinable aggregates: one row per key leaves each task, however many copies exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *, last: bool = False) -> DataFrame:
    """First (or last) row per key in ``order``, plus the number of copies."""
    rest = [c for c in df.columns if c not in keys]
    pick = (F.max_by if last else F.min_by)(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(pick.alias("_row"), F.count(F.lit(1)).alias("copies")).select(*keys, "_row.*", "copies")


# Names of the rules that drop a repeated epoch.
RULE_PUBLISHED, RULE_POR, RULE_POE, RULE_ARC, RULE_TIE = "parsed_over_published", "por_beats_vor", "poeorb_beats_moeorb", "later_arc_start", "same_arc_tiebreak"


def prioritised(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Best row per key by (origin, family, later arc, name) and, per rule, how many rows it dropped.

    ``origin`` 0 is a parsed file, 1 a published seed. The table is read and grouped once, on the ranking columns;
    both the winner and the counts come from those groups, so many equal copies become one counted row.
    """
    rank = ["origin", "family", "neg_arc", "name"]
    x = df.withColumn("neg_arc", -F.col("arc"))
    rest = [c for c in x.columns if c not in keys and c not in rank]
    kinds = x.groupBy(*keys, *rank).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_rest"))
    best = kinds.groupBy(*keys).agg(F.min(F.struct(*rank, "_rest")).alias("_b"), F.sum("_n").alias("copies"))
    won = best.select(*keys, *[F.col(f"_b.{c}").alias(f"_k_{c}") for c in rank])
    j = kinds.drop("_rest").join(won, list(keys))
    same = F.lit(True)
    for c in rank:
        same = same & (F.col(c) == F.col(f"_k_{c}"))
    rule = (
        F.when(F.col("origin") != F.col("_k_origin"), RULE_PUBLISHED)
        .when((F.col("family") != F.col("_k_family")) & F.upper("_k_name").startswith("SWOT"), RULE_POR)
        .when(F.col("family") != F.col("_k_family"), RULE_POE)
        .when(F.col("neg_arc") != F.col("_k_neg_arc"), RULE_ARC)
        .otherwise(RULE_TIE)
    )
    dropped = j.select(*keys, rule.alias("rule"), (F.col("_n") - F.when(same, 1).otherwise(0)).alias("dropped")).where("dropped > 0")
    return best.select(*keys, *[F.col(f"_b.{c}") for c in rank if c != "neg_arc"], "_b._rest.*", "copies"), dropped


def dominant_entity(df: DataFrame, by: Sequence[str], entity: str) -> DataFrame:
    """Rows of the most frequent entity of each file; equal counts keep the smaller id."""
    n = df.groupBy(*by, entity).agg(F.count(F.lit(1)).alias("_n"))
    top = n.groupBy(*by).agg(F.max_by(entity, F.struct("_n", -F.col(entity))).alias(entity))
    return df.join(top, [*by, entity], "left_semi")
