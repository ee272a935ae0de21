"""Every user against every item without a row per pair.

Users and items are cut into blocks and each block is copied to the tasks that need it, so a
task holds one user block and one item block, scores them as matrices and returns only rows
that can still be among the best k. Items that no user can have among the best k are left out
before, where the scorer can tell (``prune_items``). The shuffle carries ``2 * pairs / block size`` rows at
most, the output k rows (and ties at the cut) per user and item block.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.operators.ranking import topk_exact, topk_of_candidates
from pickwise.schemas import TOP_K
from pickwise.workspace import materialize

# Rows per block: 8192 x 8192 pairs are seconds of matrix work for a megabyte of input.
BLOCK_ROWS = 8192
# Do not cut blocks smaller than this many pairs only to use more tasks.
MIN_BLOCK_PAIRS = 1 << 20
# Scores held at once inside a task.
CHUNK_PAIRS = 1 << 20
MAX_PARTITIONS = 100_000
# Items that are compared with each other to leave some out, and intervals of users they are compared on.
PRUNE_ROWS, INTERVALS = 32_768, 128
# Scores with larger terms, or with terms that are no numbers, are not bounded: single precision might not hold them.
SINGLE = 1e37

# items (n, d) -> function scoring users (m, e) as an (m, n) matrix
PairScorer = Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]]

SCORED = "map_user_id int, parent_asin int, store_id int, predicted_rating double"


class FmScorer:
    """Cross term of the joined user and item vectors.

    Over all entries of the joined vector it depends only on the sums and square sums of the
    two sides, so a pair costs a handful of operations whatever the vector size. Without the user's
    own square sum, which is the same for all items, an item's score is a function of the user's sum
    alone: half of (that sum + item sum) squared less the item's square sum. Two items differ by a
    linear function of it, so an interval of user sums is judged by its ends.
    """

    def __call__(self, items: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        item_sum, item_squares = items.sum(axis=1), (items * items).sum(axis=1)

        def score(users: np.ndarray) -> np.ndarray:
            user_sum, user_squares = users.sum(axis=1), (users * users).sum(axis=1)
            total = user_sum[:, None] + item_sum[None, :]
            return 0.5 * (total * total - (user_squares[:, None] + item_squares[None, :]))

        return score

    def box(self, users: np.ndarray) -> np.ndarray:
        """What is added to the cross term sees nothing of a user, as there is nothing added."""
        return np.zeros((len(users), 0))

    def added(self, items: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[float, float]:
        return 0.0, 0.0

    def most_added(self, size: float) -> float:
        return 0.0

    terms = 0


fm_scorer = FmScorer()


def _sums(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the entries, and of their absolute values."""
    wide = vectors.astype(np.float64)
    return wide.sum(axis=1), np.abs(wide).sum(axis=1)


def _levels(items: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cross terms without the user's square sum for users of the sums ``at`` (n, places)."""
    wide = items.astype(np.float64)
    item_sum = wide.sum(axis=1)[:, None]
    half = 0.5 * (item_sum * item_sum - (wide * wide).sum(axis=1)[:, None])
    return half + item_sum * at[None, :]


def block_counts(n_users: int, n_items: int, slots: int) -> tuple[int, int]:
    """Number of user and item blocks: full blocks, or smaller ones to keep all slots busy."""
    user_blocks = max(1, math.ceil(n_users / BLOCK_ROWS))
    item_blocks = max(1, math.ceil(n_items / BLOCK_ROWS))
    wanted = min(4 * slots, math.ceil(n_users * n_items / MIN_BLOCK_PAIRS))
    if user_blocks * item_blocks < wanted:
        user_blocks = max(user_blocks, min(n_users, math.ceil(wanted / item_blocks)))
    return user_blocks, item_blocks


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _best_places(scores: np.ndarray, k: int, exact: bool) -> np.ndarray:
    """Mask of the scores at least as good as the k-th best of their row.

    ``exact`` keeps k per row, the leftmost of the scores tied at the cut.
    """
    if k >= scores.shape[1]:
        return np.ones(scores.shape, dtype=bool)
    cut = np.partition(scores, -k, axis=1)[:, [-k]]
    if not exact:
        return scores >= cut
    better, tied = scores > cut, scores == cut
    room = k - better.sum(axis=1, keepdims=True)
    return better | (tied & (np.cumsum(tied, axis=1) <= room))


def _best_of_block(k: int, scorer: PairScorer, exact: bool):
    """Task function: the rows of a user block that an item block may add to the best k."""

    def best(_, users: pa.Table, items: pa.Table) -> pa.Table:
        empty = pa.table(
            {
                "map_user_id": pa.array([], pa.int32()),
                "parent_asin": pa.array([], pa.int32()),
                "store_id": pa.array([], pa.int32()),
                "predicted_rating": pa.array([], pa.float64()),
            }
        )
        if users.num_rows == 0 or items.num_rows == 0:
            return empty
        items = items.sort_by([("parent_asin", "ascending"), ("store_id", "ascending")])
        score = scorer(_matrix(items, "item_vector"))
        user_matrix = _matrix(users, "user_vector")
        user_ids = users.column("map_user_id").to_numpy()
        asins, stores = items.column("parent_asin").to_numpy(), items.column("store_id").to_numpy()
        step = max(1, CHUNK_PAIRS // items.num_rows)
        parts = []
        for start in range(0, users.num_rows, step):
            scores = np.asarray(score(user_matrix[start : start + step]), dtype=np.float64)
            # NaN is no score: it becomes NULL and ranks behind every number.
            unknown = np.isnan(scores)
            row, column = np.nonzero(_best_places(np.where(unknown, -np.inf, scores), k, exact))
            parts.append(
                pa.table(
                    {
                        "map_user_id": pa.array(user_ids[start + row], pa.int32()),
                        "parent_asin": pa.array(asins[column], pa.int32()),
                        "store_id": pa.array(stores[column], pa.int32()),
                        "predicted_rating": pa.array(scores[row, column], mask=unknown[row, column]),
                    }
                )
            )
        return pa.concat_tables(parts)

    return best


def block_best(
    users: DataFrame, items: DataFrame, scorer: PairScorer, k: int, exact: bool = False
) -> DataFrame:
    """Candidates left after scoring all pairs: a superset of each user's best rows.

    ``users`` has (map_user_id, user_vector), ``items`` (parent_asin, store_id, item_vector);
    both without repeats, so blocks are even whatever the skew of the source tables. Both are
    counted and then read: pass written tables.
    """
    context = users.sparkSession.sparkContext
    user_blocks, item_blocks = block_counts(
        users.count(), items.count(), context.defaultParallelism
    )
    # A fixed partition count: adaptive coalescing would judge by bytes, and here a few bytes
    # stand for seconds of work.
    partitions = min(user_blocks * item_blocks, MAX_PARTITIONS)
    pairs = ["user_block", "item_block"]
    user_side = (
        users.withColumn("user_block", F.pmod(F.hash("map_user_id"), F.lit(user_blocks)))
        .withColumn("item_block", F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1))))
        .repartition(partitions, *pairs)
    )
    item_side = (
        items.withColumn(
            "item_block", F.pmod(F.hash("parent_asin", "store_id"), F.lit(item_blocks))
        )
        .withColumn("user_block", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))))
        .repartition(partitions, *pairs)
    )
    return (
        user_side.groupBy(*pairs)
        .cogroup(item_side.groupBy(*pairs))
        .applyInArrow(_best_of_block(k, scorer, exact), SCORED)
    )


def prune_items(users: DataFrame, items: DataFrame, scorer: PairScorer, k: int) -> DataFrame:
    """The items that may be among some user's best k (ties kept); all of them if ``scorer`` cannot tell.

    The range of the users is cut into ``INTERVALS``. An item goes if in every interval at least k
    others are better than it all over the interval, by more than rounding can change. Every task
    compares the items of a bucket, then the rest is dealt to fewer buckets, as long as that helps. Nothing
    is assumed of the items: if all may be best for someone, all stay. Items with a score that is no
    finite number stay too.
    """
    left, columns = items.count(), items.schema
    if not hasattr(scorer, "added") or left * users.count() <= MIN_BLOCK_PAIRS:
        return items
    cells = _user_cells(users, scorer)
    if cells is None:
        return items
    while left > PRUNE_ROWS:
        buckets = math.ceil(left / PRUNE_ROWS)
        dealt = items.repartition(buckets, F.xxhash64("parent_asin", "store_id", F.lit(buckets)))
        items = materialize(dealt.mapInArrow(_kept_items(scorer, cells, k), columns), "pruned")
        before, left = left, items.count()
        if left > before / 2:
            return items
    return materialize(items.repartition(1).mapInArrow(_kept_items(scorer, cells, k), columns), "pruned")


@dataclass
class Cells:
    """Users by intervals of their sums: the ends, and the boxes of the intervals that have users."""

    ends: np.ndarray
    boxes: dict[int, tuple[np.ndarray, np.ndarray]]
    size: float  # largest sum of absolute entries
    width: int


def _user_cells(users: DataFrame, scorer) -> Cells | None:
    """None if there are no users, or some with entries that are no finite numbers."""

    def ranges(batches):
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(pa.Table.from_batches([batch]), "user_vector")
                at, size = _sums(matrix)
                row = {"low": at.min(), "high": at.max(), "size": size.max(), "width": matrix.shape[1]}
                yield pa.RecordBatch.from_pydict({name: [value] for name, value in row.items()})

    given = users.select("user_vector").filter(F.col("user_vector").isNotNull())
    found = given.mapInArrow(ranges, "low double, high double, size double, width long")
    # NaN is the largest number here and in numpy's extremes.
    found = found.agg(F.min("low"), F.max("high"), F.max("size"), F.max("width")).head()
    if not found[3] or not all(map(math.isfinite, found)):
        return None
    ends = np.linspace(found[0], found[1], INTERVALS + 1)

    def boxes(batches):
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(pa.Table.from_batches([batch]), "user_vector")
                cell = np.clip(np.searchsorted(ends, _sums(matrix)[0], "right") - 1, 0, INTERVALS - 1)
                box = scorer.box(matrix)
                for n in np.unique(cell):
                    here = box[cell == n]
                    places = np.arange(-1, here.shape[1], dtype=np.int32)  # -1 says that there are users
                    yield pa.RecordBatch.from_pydict(
                        {
                            "cell": pa.array(np.full(len(places), n), pa.int32()), "place": places,
                            "low": np.append(0.0, here.min(axis=0)), "high": np.append(0.0, here.max(axis=0)),
                        }
                    )

    found_boxes = given.mapInArrow(boxes, "cell int, place int, low double, high double")
    rows = found_boxes.groupBy("cell", "place").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    held: dict[int, list] = {}
    # As many rows as intervals times units of the first layer.
    for row in sorted(rows.collect(), key=lambda row: (row["cell"], row["place"])):
        held.setdefault(row["cell"], []).append((row["low"], row["high"]))
    parts = {cell: np.array(box[1:]).reshape(-1, 2) for cell, box in held.items()}
    boxes_of = {cell: (box[:, 0], box[:, 1]) for cell, box in parts.items()}
    return Cells(ends, boxes_of, found[2], found[3])


def _kept_items(scorer, cells: Cells, k: int):
    def kept(batches):
        batches = list(batches)
        table = pa.Table.from_batches(batches) if batches else None
        if table is None or not table.num_rows:
            return
        vectors = _matrix(table, "item_vector")
        with np.errstate(all="ignore"):
            at_ends, size = _levels(vectors, cells.ends), _sums(vectors)[1]
        stays = ~np.isfinite(at_ends).all(axis=1)
        good = np.flatnonzero(~stays)
        # More than the rounding of two scores in single precision: sums of so many terms of such size.
        largest = (size[good].max() if len(good) else 0.0) + cells.size
        most_terms = largest**2 + scorer.most_added(largest)
        if len(good) <= k or not most_terms < SINGLE:
            stays[:] = True
        else:
            terms = vectors.shape[1] + cells.width + scorer.terms
            slack = 4 * terms * np.finfo(np.float32).eps * most_terms
            for n, box in cells.boxes.items():
                pair = at_ends[good, n : n + 2]
                low, high = scorer.added(vectors[good], *box)
                least, most = pair.min(axis=1) + low, pair.max(axis=1) + high
                bar = np.partition(least, -k)[-k]
                stays[good[most >= bar - slack]] = True
        yield from table.filter(pa.array(stays)).combine_chunks().to_batches()

    return kept


def score_topk(
    users: DataFrame, items: DataFrame, scorer: PairScorer, k: int = TOP_K, exact: bool = False
) -> DataFrame:
    """Rows of rank <= k per user over all items, ties kept; ``exact`` keeps exactly k rows."""
    best = block_best(users, prune_items(users, items, scorer, k), scorer, k, exact)
    if exact:
        ties = ["parent_asin", "store_id"]
        return topk_exact(best, "map_user_id", "predicted_rating", ties, k)
    # One write: the ranks read the candidates twice and must not score the pairs again.
    return topk_of_candidates(
        materialize(best, "block-best"), "map_user_id", "predicted_rating", k
    )
