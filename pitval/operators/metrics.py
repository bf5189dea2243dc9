"""Regression scores, rank correlation, hit rates and gap summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval.operators.skew import crowded_buckets, salted_join, with_running_total
from pitval.session import materialize


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE and R-squared in one aggregation, optionally per group."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    spread = F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), spread)).alias("r2"),
    )


def centred_ranks(counted: DataFrame, value: str, out: str) -> DataFrame:
    """Average rank of every distinct value less the mean rank; ties share one rank."""
    ranked = with_running_total(
        counted.groupBy(value).agg(F.sum("_n").alias("_n")), [value], "_n", "_before", "_total"
    )
    average = F.col("_before") + (F.col("_n") + 1) / 2
    return ranked.select(value, (average - (F.col("_total") + 1) / 2).alias(out))


def spearman(df: DataFrame, x: str, y: str, out: str = "rho") -> DataFrame:
    """Rank correlation with average ranks for ties, as a one-row frame.

    Equal (x, y) points are counted together before anything is sorted, ranks come from
    range-partitioned running totals rather than a one-task window, and a value shared by
    many points is spread by the salted join.
    """
    points = materialize(
        df.select(F.col(x).alias("_x"), F.col(y).alias("_y"))
        .dropna()
        .groupBy("_x", "_y")
        .agg(F.count(F.lit(1)).alias("_n")),
        "points",
    )
    ranked = points
    for value, rank in (("_x", "_rx"), ("_y", "_ry")):
        ranks = centred_ranks(points, value, rank)
        crowded = crowded_buckets(points, [value])
        ranked = salted_join(ranked, ranks, [value], "inner", crowded=crowded)
    n, rx, ry = F.col("_n"), F.col("_rx"), F.col("_ry")
    return ranked.agg(
        F.try_divide(
            F.sum(n * rx * ry), F.sqrt(F.sum(n * rx * rx)) * F.sqrt(F.sum(n * ry * ry))
        ).alias(out)
    )


def hit_rate(df: DataFrame, value: str, out: str = "rate") -> DataFrame:
    """Share of rows whose value is positive; a missing value counts as not positive."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col(value) > 0, 1.0).otherwise(0.0)).alias(out),
    )


def precision_at_k(
    df: DataFrame, score: str, value: str, k: int, tie: str = "entity_id"
) -> DataFrame:
    """Hit rate among the ``k`` rows with the highest score."""
    top = df.orderBy(F.col(score).desc_nulls_last(), F.col(tie).asc()).limit(k)
    return hit_rate(top, value)


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """Count of each value and its share of all rows in percent."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total)


def pair_gaps(pairs: DataFrame, realized: DataFrame, value: str = "realized_value") -> DataFrame:
    """Absolute difference in realized value of the two ends of each pair."""
    side_a = realized.select(F.col("entity_id").alias("entity_id_a"), F.col(value).alias("_va"))
    side_b = realized.select(F.col("entity_id").alias("entity_id_b"), F.col(value).alias("_vb"))
    return (
        pairs.join(side_a, "entity_id_a")
        .join(side_b, "entity_id_b")
        .withColumn("realized_gap", F.abs(F.col("_va") - F.col("_vb")))
        .drop("_va", "_vb")
    )


def hashed_pairs(ids: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """``k`` reproducible random pairs of distinct entities, fewer only if fewer exist.

    Entities are put in the order of a hash of their id and consecutive ones are paired.
    Taking the first ``k + 1`` keeps the work to a top-k; if there are not that many,
    further rounds with another offset are added.
    """
    mixed = F.md5(F.concat(F.lit(f"{seed}:"), F.col("entity_id").cast("string")))
    first = ids.select("entity_id", mixed.alias("_h")).orderBy("_h", "entity_id").limit(k + 1)
    chosen = first.agg(
        F.array_sort(F.collect_list(F.struct("_h", "entity_id"))).alias("_all")
    ).withColumn("_ids", F.transform("_all", lambda s: s["entity_id"]))
    n = F.size("_ids")
    # Offset 1 gives n - 1 pairs, offset 2 n - 2, ...: all of them are distinct pairs.
    numbered = (
        chosen.withColumn("_offset", F.explode(F.when(n > 1, F.sequence(F.lit(1), n - 1))))
        .withColumn("_i", F.explode(F.sequence(F.lit(0), n - F.col("_offset") - 1)))
        .select(
            "_offset",
            "_i",
            F.element_at("_ids", F.col("_i") + 1).alias("_first"),
            F.element_at("_ids", F.col("_i") + F.col("_offset") + 1).alias("_second"),
        )
    )
    return (
        numbered.orderBy("_offset", "_i")
        .limit(k)
        .select(
            F.least("_first", "_second").alias("entity_id_a"),
            F.greatest("_first", "_second").alias("entity_id_b"),
        )
    )
