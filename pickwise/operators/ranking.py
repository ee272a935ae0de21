"""Competition ranks, top-k per user and recommendation lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.operators.ordering import running_totals
from pickwise.operators.skew import hot_keys, split_join
from pickwise.schemas import TOP_K
from pickwise.workspace import materialize


def rank_rows(df: DataFrame, key: str, score: str, rank: str = "rank") -> DataFrame:
    """Rank of every row within its key by descending score, gaps after ties.

    One count per key names the hot keys. All others are ranked by a window; rows of hot keys by
    counts per (key, score), so that no key meets in one task. ``df`` is read more than once.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    hot = hot_keys(counts, [key], "__rows")
    best = Window.partitionBy(key).orderBy(F.desc_nulls_last(score))
    ranks = F.rank().over(best).cast("long")
    if hot is None:
        return df.withColumn(rank, ranks)
    few = F.broadcast(hot.toDF("__hot"))
    is_hot = F.col(key).eqNullSafe(F.col("__hot"))
    plain = df.join(few, is_hot, "left_anti").withColumn(rank, ranks)
    return plain.unionByName(_counted_ranks(df.join(few, is_hot, "left_semi"), key, score, rank))


def _counted_ranks(df: DataFrame, key: str, score: str, rank: str) -> DataFrame:
    """A rank is one plus the number of better rows of the key, so it follows from counts per
    (key, score): the rows of a key are spread over many ranges, not one window."""
    counts = materialize(
        df.groupBy(key, score).agg(F.count(F.lit(1)).alias("__n")), "score-counts"
    )
    placed = running_totals(
        counts, [F.asc_nulls_first(key), F.desc_nulls_last(score)], "__n", "__before"
    )
    first = materialize(
        placed.groupBy(F.col(key).alias("__key")).agg(
            F.min("__before").alias("__first"), F.count(F.lit(1)).alias("__scores")
        ),
        "first-rows",
    )
    hot = hot_keys(first, ["__key"], "__scores")
    ranks = split_join(placed, first, [key], ["__key"], hot=hot, null_safe=True).select(
        "__key",
        F.col(score).alias("__score"),
        (F.col("__before") - F.col("__first") + 1).alias(rank),
    )
    return _attach(df, key, score, ranks, rank, hot_keys(counts, [key, score], "__n"))


def _attach(
    df: DataFrame, key: str, score: str, ranks: DataFrame, rank: str, hot: DataFrame | None
) -> DataFrame:
    ranked = split_join(df, ranks, [key, score], ["__key", "__score"], hot=hot, null_safe=True)
    return ranked.select(*df.columns, rank)


def _best_scores(df: DataFrame, key: str, score: str, k: int, rank: str, copies=None) -> DataFrame:
    """(key, score, rank) of the scores whose rank is at most ``k``: at most k rows per key.

    Rows are counted per (key, score) before the shuffle; only the k best scores of a key can
    have a rank up to k, and Spark drops the others before the shuffle by key as well.
    """
    weight = F.sum(copies) if copies else F.count(F.lit(1))
    counts = df.groupBy(key, score).agg(weight.alias("__n"))
    by_score = Window.partitionBy(key).orderBy(F.desc_nulls_last(score))
    best = counts.withColumn("__place", F.row_number().over(by_score)).filter(
        F.col("__place") <= k
    )
    better = by_score.rowsBetween(Window.unboundedPreceding, -1)
    return (
        best.withColumn(rank, F.coalesce(F.sum("__n").over(better), F.lit(0)) + 1)
        .filter(F.col(rank) <= k)
        .withColumn(rank, F.col(rank).cast("int"))
        .select(F.col(key).alias("__key"), F.col(score).alias("__score"), rank, "__n")
    )


def topk_with_ties(
    df: DataFrame, key: str, score: str, k: int = TOP_K, rank: str = "rank", copies: str | None = None
) -> DataFrame:
    """Rows with rank at most ``k`` within their key; ties at the cut are all kept.

    ``copies`` names a column saying how many identical rows a row stands for.

    First every task keeps its own rows of rank up to k per key (window group limit, before
    the shuffle; the key is salted with the task, so a hot key stays spread). What is left is
    a superset of the result that holds every better row, so the ranks taken from it are exact.
    """
    salted = df.withColumn("__task", F.spark_partition_id())
    local = Window.partitionBy(key, "__task").orderBy(F.desc_nulls_last(score))
    candidates = (
        salted.withColumn("__local", F.rank().over(local))
        .filter(F.col("__local") <= k)
        .drop("__task", "__local")
    )
    # Written once: they are read for the ranks and for the rows, and ``df`` may be costly.
    return topk_of_candidates(materialize(candidates, "topk"), key, score, k, rank, copies)


def topk_of_candidates(
    df: DataFrame, key: str, score: str, k: int = TOP_K, rank: str = "rank", copies: str | None = None
) -> DataFrame:
    """The same for rows already cut down to a few per key and task."""
    best = materialize(_best_scores(df, key, score, k, rank, copies), "best-scores")
    hot = hot_keys(best, ["__key", "__score"], "__n")
    return _attach(df, key, score, best.drop("__n"), rank, hot)


def topk_exact(
    df: DataFrame,
    key: str,
    score: str,
    tie_break: Sequence[str],
    k: int = TOP_K,
    rank: str = "rank",
) -> DataFrame:
    """Exactly the best ``k`` rows per key, ties decided by ``tie_break``.

    Spark keeps k rows per key and task before the shuffle (window group limit).
    """
    best = Window.partitionBy(key).orderBy(F.desc_nulls_last(score), *tie_break)
    return df.withColumn(rank, F.row_number().over(best)).filter(F.col(rank) <= k)


def ranks_with_repeats(ranked: DataFrame, repeats: DataFrame, key: str, k: int = TOP_K) -> DataFrame:
    """Ranks when the requests of a key come ``repeats`` times, each copy ranked as a row.

    With n copies of every row, a row of rank r moves to rank n * (r - 1) + 1; the result has
    one row per item with its new rank and the number of copies instead of the copies.
    """
    n = F.col("repeats").cast("long")
    moved = n * (F.col("rank") - 1) + 1
    return (
        ranked.join(repeats, key)
        .withColumn("rank", moved)
        .filter(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("int"))
        .withColumnRenamed("repeats", "copies")
    )


def recommendation_lists(ranked: DataFrame) -> DataFrame:
    """(user_id, asin, rank) to one list per user, best first, ties by item."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "asin")))
    return ranked.groupBy("user_id").agg(
        F.transform(ordered, lambda entry: entry["asin"]).alias("top_k_asins")
    )
