import math
import zlib
from collections import Counter

import xxhash
from edge import ROWS, docs, empty

from pickwise.llm import sharding
from pickwise.llm.queries import op3_sharding


def draw(key, shard, weight=1.0):
    text = ("null" if key is None else f"={key}") + f":{shard}"
    part = xxhash.xxh64(text.encode(), seed=42).intdigest() >> 12
    return -math.log((part + 0.5) / (1 << 52)) / weight


def brute(key, shards, weights=None):
    return min(range(shards), key=lambda s: draw(key, s, weights[s] if weights else 1.0))


def check(rows, given):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (n, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for n, t in given
    )
    for r in rows:
        assert (r.shard, r.grown_shard) == (brute(r.doc_id, 40), brute(r.doc_id, 41))
        assert r.grown_shard in (r.shard, 40) and r.law == "key"
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(
            range(sum(r.shard == shard for r in rows))
        )


def test_edge_rows(spark):
    check(sharding.shard_documents(docs(spark, ROWS)).collect(), ROWS)
    assert sharding.shard_documents(empty(spark)).count() == 0


def test_hot_key_and_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 7)
    given = [(9, "same")] * 300 + [(n, str(n)) for n in range(200)]
    check(sharding.shard_documents(docs(spark, given).repartition(5)).collect(), given)


def test_weights_move_only_what_the_subtree_wins(spark):
    weights = [1.0, 2.0, 0.5, 1.0, 3.0, 1.0, 1.0]
    heavier = [*weights[:5], 4.0, 1.0]
    trees = {
        "old": sharding.hash_tree(7, 2, 2, weights), "new": sharding.hash_tree(7, 2, 2, heavier),
    }
    rows = sharding.add_shard(spark.range(6000), "id", trees).collect()
    for r in rows[:500]:
        assert (r.old, r.new) == (brute(r.id, 7, weights), brute(r.id, 7, heavier))
    assert {r.new for r in rows if r.new != r.old} == {5}
    shares = Counter(r.old for r in rows)
    for shard, weight in enumerate(weights):
        assert abs(shares[shard] / 6000 - weight / sum(weights)) < 0.03


def test_query(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check(op3_sharding(spark, sf_dir).collect(), [tuple(r) for r in given])
