import math
import random
import re

import pytest
from check import compare, compare_types, connect
from edge import ROWS, docs, empty

from pickwise.llm import quality
from pickwise.llm.queries import ORACLE_SQL, op7_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """The base counts by their definitions."""
    text = text or ""
    words = WORD.findall(text)
    seen = {}
    for at in range(len(words) - 7):
        seen.setdefault(tuple(words[at : at + 8]), []).append(at)
    covered = {p + n for found in seen.values() if len(found) > 1 for p in found for n in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def check(spark, given):
    got = quality.assess(docs(spark, given)).collect()
    found = sorted(
        repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))
        for r in got
    )
    assert found == sorted(repr((n, *counts(t))) for n, t, *_ in given)
    return {r.doc_id: r for r in got}


def test_counts_by_definition(spark):
    rng = random.Random(4)
    parts = ["a", "b", "é#", "|", "\n", "\n\n", " ", "\t\x0b", "\x1f", "a b a b a b a b a b"]
    given = [
        (n, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for n in range(300)
    ]
    check(spark, given)


def test_edge_rows(spark):
    check(spark, ROWS)
    check(spark, [(1, "en text", None), (2, "x " * 200, "unknown"), (3, None, None)])
    assert quality.assess(empty(spark)).count() == 0
    kept = quality.keep_good(docs(spark, ROWS))
    assert kept.columns == docs(spark, ROWS).columns


def prose(rng, n):
    common = quality.COMMON_WORDS["en"]
    rare = lambda: "".join(rng.choice("abcdeinorst") for _ in range(rng.randint(3, 9)))
    return " ".join(rng.choice(common) if rng.random() < 0.4 else rare() for _ in range(n))


def test_verdicts(spark):
    rng = random.Random(6)
    good = [(n, prose(rng, rng.randint(20, 400))) for n in range(60)]
    symbols = (100, " ".join(w + "***" for w in prose(rng, 200).split()))
    listed = (101, " ".join("".join(rng.choice("abcdeinorst") for _ in range(6)) for _ in range(300)))
    short_symbols = (102, " ".join(w + "***" for w in prose(rng, 30).split()))
    unknown = (103, symbols[1], "xx")
    given = [*good, symbols, listed, short_symbols, unknown]
    kept = {n for n, r in check(spark, given).items() if r.kept}
    assert kept == {n for n, _ in good} | {102, 103}
    table = docs(spark, given)
    assert {tuple(r) for r in quality.keep_good(table).collect()} == {
        tuple(r) for r in table.collect() if r.doc_id in kept
    }


def test_distance(spark):
    row = spark.createDataFrame([([1, 1], [2, 2], [0, 5], [0, 0])], "a array<long>, b array<long>, c array<long>, z array<long>")
    got = row.select(
        quality.distance("a", "b"), quality.distance("a", "c"), quality.distance("a", "z")
    ).head()
    half = 0.5 * math.log2(0.5 / 0.5)
    expected = math.sqrt((0.5 + half + 0.5 * math.log2(0.5 / 0.75) + 1 * math.log2(1 / 0.75)) / 2)
    assert got[0] == 0 and got[1] == pytest.approx(expected) and got[2] == 0


def test_native(spark, sf_dir):
    plan = op7_quality(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_matches_sql(spark, sf_dir):
    connection = connect(sf_dir)
    df = op7_quality(spark, sf_dir)
    assert compare(df, connection, ORACLE_SQL["op7_quality"]) == []
    assert compare_types(df, connection, ORACLE_SQL["op7_quality"]) == []


def test_texts_are_read_in_small_batches(spark):
    """With Spark's 4,096 rows a batch of texts takes tens of MB, several times over, in every task."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    given = docs(spark, [(1, "a")])
    try:
        for run in (quality.keep_good, quality.assess):
            spark.conf.unset(name)
            run(given)
            assert int(spark.conf.get(name)) <= 512
        spark.conf.set(name, "1000")
        quality.keep_good(given)
        assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.unset(name)
