"""Parsing, labels and the three missing-value rules on the edge rows."""

from conftest import rows
from pyspark.sql import functions as F

from pickwise.functions import scalars
from pickwise.models import registry
from pickwise.operators import ordering, relational, vocabulary
from pickwise.schemas import (
    ACTION_MESSAGE,
    ITEM_MAP,
    MODEL_VERSIONS,
    REQUEST_MESSAGE,
    USER_MAP,
)


def _map(spark, values):
    return spark.createDataFrame(list(values.items()), "value string, idx int")


def test_bad_messages_give_null_fields(spark):
    messages = [
        ('{"timestamp":5,"rating":4.5,"user_id":"U1","parent_asin":"P1"}',),
        ("not json",),
        (None,),
        ('{"timestamp":1588687728923,"rating":1.0,"user_id":"U2","parent_asin":"P2"}',),
        ('{"timestamp":6,"rating":"x","user_id":"U3","parent_asin":"P3"}',),
    ]
    df = spark.createDataFrame(messages, "value string")
    parsed = df.select(scalars.parse_json(F.col("value"), ACTION_MESSAGE).alias("d")).select("d.*")
    assert [tuple(r) for r in parsed.collect()] == [
        (5, 4.5, "U1", "P1"),
        (None, None, None, None),
        (None, None, None, None),
        (None, 1.0, "U2", "P2"),
        (6, None, "U3", "P3"),
    ]
    request = df.select(scalars.parse_json(F.encode("value", "utf-8"), REQUEST_MESSAGE).alias("d"))
    assert [r["d"]["user_id"] if r["d"] else None for r in request.collect()] == [
        "U1", None, None, "U2", "U3",
    ]


def test_label_threshold(spark):
    df = spark.createDataFrame([(4.5,), (4.4,), (None,), (float("nan"),)], "rating double")
    got = df.select(scalars.binarize(F.col("rating")).alias("y")).collect()
    assert [r.y for r in got] == [1, 0, 0, 0]


def test_missing_value_rules(spark):
    df = spark.createDataFrame([("eve",), ("nobody",), (None,)], "user_id string")
    users = _map(spark, {"ana": 0, "eve": 1})
    assert rows(vocabulary.encode(df, "user_id", users, "minus_one")) == [(-1,), (-1,), (1,)]
    assert rows(vocabulary.encode(df, "user_id", users, "null", "id").select("id")) == [
        (1,), (None,), (None,)
    ]
    assert rows(vocabulary.encode(df, "user_id", users, "drop")) == [(1,)]


def test_null_is_a_value_of_its_own(spark):
    df = spark.createDataFrame([("A",), (None,), ("A",), ("B",)], "user_id string")
    users = vocabulary.build_vocabulary(df, "user_id", USER_MAP)
    assert sorted(r.idx for r in users.collect()) == [0, 1, 2]
    encoded = vocabulary.encode(df, "user_id", users.drop("feature"), "minus_one")
    assert -1 not in [r.user_id for r in encoded.collect()]


def test_decode_undoes_encode(spark):
    df = spark.createDataFrame([(f"item {i % 97}",) for i in range(500)], "parent_asin string")
    items = vocabulary.build_vocabulary(df, "parent_asin", ITEM_MAP)
    assert sorted(r.idx for r in items.collect()) == list(range(97))
    encoded = vocabulary.encode(df, "parent_asin", items, "minus_one", output="id")
    back = vocabulary.decode(encoded, "id", items, "again")
    assert back.filter(F.col("again") != F.col("parent_asin")).count() == 0
    assert back.count() == 500
    inverse = {r.key: r.original for r in vocabulary.invert_map(items).collect()}
    assert inverse == {r.idx: r.value for r in items.collect()}


def test_join_keeps_duplicates_and_drops_unknown(spark):
    ratings = spark.createDataFrame(
        [(1, 5.0, "U1", "P1"), (2, 5.0, "U1", "P3"), (3, 1.0, "U2", "P4"), (4, 1.0, "U2", None)],
        "timestamp long, rating double, user_id string, parent_asin string",
    )
    metadata = spark.createDataFrame(
        [("P1", "s"), ("P1", "s"), ("P4", None), (None, "s")], "parent_asin string, store string"
    )
    joined = relational.join_ratings_metadata(ratings, metadata)
    assert joined.count() == 3
    assert relational.drop_nulls(joined, ["store"]).count() == 2


def test_low_occurrence_and_null_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "k string")
    assert rows(relational.filter_low_occurrence(df, "k", 3)) == [("a",)] * 3
    assert rows(relational.value_counts(df, "k")) == [("a", 3), ("b", 1)]


def test_union_skips_absent_parts_and_fills_columns(spark):
    left = spark.createDataFrame([("P", "U")], "parent_asin string, user_id string")
    right = spark.createDataFrame([("V", "Q", 5.0)], "user_id string, parent_asin string, rating double")
    assert rows(relational.union_all(None, right)) == [("V", "Q", 5.0)]
    assert rows(relational.union_all(left, None, right, fill_missing=True)) == [
        ("P", "U", None), ("Q", "V", 5.0)
    ]


def test_empty_registry(spark):
    empty = spark.createDataFrame([], MODEL_VERSIONS)
    assert registry.latest_version(empty).count() == 0
    assert registry.next_version(empty).head()["next_version"] == 0


def test_next_version_follows_the_newest_entry(spark):
    df = spark.createDataFrame([("m", 1, 9), ("m", 2, 4)], "model string, timestamp long, version int")
    assert registry.next_version(df).head()["next_version"] == 5
    assert registry.last_registered(df).head()["version"] == 9


def test_fm_cross_term(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
    assert df.select(scalars.fm_cross_term(F.col("v")).alias("c")).head()["c"] == 11.0


def test_epoch_seconds_in_any_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.sql(
                "SELECT timestamp_seconds(1600000000) AS z, timestamp_ntz '2020-09-13 12:26:40' AS n"
            ).select(scalars.epoch_seconds(F.col("z")), scalars.epoch_seconds(F.col("n"))).head()
            assert tuple(row) == (1600000000, 1600000000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_promised_orders(spark):
    data = [(n * 7 % 50, f"v{n % 9 % 4}", [f"v{n % 5}", "x"]) for n in range(200)] + [(None, None, ["x"])]
    df = spark.createDataFrame(data, "time int, value string, features array<string>").repartition(7)
    times = [r.time for r in ordering.sort_by(df, "time").collect()]
    assert times == sorted(times, key=lambda t: (t is not None, t or 0))
    counts = [(r.value, r.n) for r in relational.value_counts(df, "value").collect()]
    assert counts == sorted(counts, key=lambda c: (-c[1], c[0])) and None not in dict(counts)
    top = [(r.value, r.n) for r in relational.explode_value_counts(df, "features", 3).collect()]
    assert top == [("x", 201), ("v0", 40), ("v1", 40)]


def test_extended_vocabulary_keeps_its_ids(spark):
    columns = {USER_MAP: "u", ITEM_MAP: "i"}
    first = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "y")], "u string, i string")
    second = spark.createDataFrame([("c", "x"), ("b", "z"), ("d", None), (None, "x")], "u string, i string")
    known = vocabulary.build_vocabularies(first, columns)
    more = vocabulary.extend_vocabularies(known, second, columns)
    again = vocabulary.extend_vocabularies(more, second, columns)
    assert rows(again) == rows(more) and set(rows(known)) < set(rows(more))
    for feature, size in ((USER_MAP, 5), (ITEM_MAP, 4)):
        assert sorted(r.idx for r in more.filter(F.col("feature") == feature).collect()) == list(range(size))
    new = vocabulary.extend_vocabularies(known.filter(F.col("feature") == USER_MAP), second, columns)
    assert sorted(r.idx for r in new.filter(F.col("feature") == ITEM_MAP).collect()) == [0, 1, 2]
    none = spark.createDataFrame([], "u string, i string")
    assert rows(vocabulary.extend_vocabularies(known, none, columns)) == rows(known)
