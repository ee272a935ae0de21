import hashlib
import random
import re

import pyarrow as pa
import pytest
from edge import LONG, ROWS, docs, empty

from pickwise.llm import decontam
from pickwise.llm.queries import op5_decontam

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").encode().lower())


def expected(given, items, window=10):
    windows = {}
    for name, text in items:
        words = split(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[at : at + size]), set()).add(name)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in given:
        words = split(text)
        hit, names = set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if found := windows.get(tuple(words[at : at + size])):
                    hit.update(range(at, at + size))
                    names |= found
        listed = sorted(str(n) for n in names if n is not None)
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(listed), digest, bool(hit)))
    return sorted(map(repr, out))


def items_table(spark, items):
    rows = [(n, t, "x", "y") for n, t in items]
    return spark.createDataFrame(rows, "item_id long, text string, hits string, n_words string")


def test_small_alphabet(spark):
    """Few words, so that runs of items overlap in all ways; short items and blocks included."""
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice(["a", "B", "c-c", "é"]) for _ in range(n))
    items = [(n, text(rng.choice([1, 3, 4, 5, 6, 9, 14]))) for n in range(3, 40)]
    items = [x for x in items if len(split(x[1])) > 2] + [(1, None), (2, ""), (None, text(12)), (5, text(6))]
    given = [(n, text(rng.randint(0, 60))) for n in range(60)]
    for block_bytes in (1 << 20, 60):
        got = decontam.find_overlaps(docs(spark, given), items_table(spark, items), 5, block_bytes)
        got = sorted(repr(tuple(r)) for r in decontam.digests(got).collect())
        assert got == expected(given, items, 5)


def test_automaton_against_all_runs():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(8)]
    words, _, _, first, _ = decontam._lower_words(pa.array(texts))
    automaton = decontam.SuffixAutomaton(
        [(str(n), words[a:b]) for n, (a, b) in enumerate(zip(first, first[1:]))], 3
    )
    stream = [rng.randint(0, len(automaton.words) - 1) for _ in range(300)]
    runs = {tuple(r[a:b]) for r in (automaton.numbers(words[x:y]).tolist() for x, y in zip(first, first[1:]))
            for a in range(len(r)) for b in range(a + 1, len(r) + 1)}
    for at, (_, size) in enumerate(automaton.walk(stream)):
        longest = max((n for n in range(1, at + 2) if tuple(stream[at + 1 - n : at + 1]) in runs), default=0)
        assert size == longest


def test_edge_rows(spark):
    items = [(1, "plain words of a text"), (2, None), (3, " . "), (4, "dogs the quick brown fox uber uber")]
    got = decontam.digests(decontam.find_overlaps(docs(spark, ROWS), items_table(spark, items)))
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(ROWS, items)
    assert decontam.find_overlaps(empty(spark), items_table(spark, items)).count() == 0
    none = decontam.find_overlaps(docs(spark, ROWS), items_table(spark, []))
    assert none.filter("size(hits) > 0").count() == 0 and none.count() == len(ROWS)


def test_decontaminate(spark):
    item = "one two three four five six seven eight nine ten"
    given = [
        (1, f"Before it, {item.upper()}! And after it {'word ' * 20}"), (2, item), (3, "clean"),
        (4, None), (5, ""), (6, LONG), (None, f"é {item} z{' q' * 20}"),
    ]
    table = docs(spark, given)
    got = decontam.decontaminate(table, items_table(spark, [(1, item)]))
    assert got.schema == table.schema
    assert {r.doc_id: r.text for r in got.collect()} == {
        1: f"Before it, ! And after it {'word ' * 20}", 3: "clean", 4: None, 5: "", 6: LONG,
        None: f"é  z{' q' * 20}",
    }


def test_decontaminate_in_blocks_as_at_once(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice(["a", "B", "c-c", "é"]) for _ in range(n))
    items = items_table(spark, [(n, text(rng.choice([4, 5, 6, 9]))) for n in range(30)])
    table = docs(spark, [(n, text(rng.randint(0, 60))) for n in range(60)] + [(None, None)])
    one, many = (
        sorted(map(repr, decontam.decontaminate(table, items, 5, 0.9, size).collect())) for size in (1 << 20, 60)
    )
    assert one == many and 0 < len(one)


def test_marks_are_cut_out_by_the_worker_that_found_them(spark):
    """Each further map is another Python worker per task, which keeps its memory when it is done."""
    table = docs(spark, [(1, "a")])
    got = decontam.decontaminate(table, items_table(spark, [(1, "one two three")]))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_query_by_brute_force(spark, sf_dir):
    read = lambda name, key: [
        tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(key, "text").collect()
    ]
    got = op5_decontam(spark, sf_dir).collect()
    assert any(r.contaminated for r in got)
    assert sorted(repr(tuple(r)) for r in got) == expected(
        read("documents", "doc_id"), read("benchmark", "item_id")
    )


def test_repeated_items_do_not_fill_a_block(spark):
    """A third of the rows is one item: it goes into one block, once."""
    items = [(n, " ".join(f"w{n}x{k}" for k in range(12))) for n in range(100)]
    items += [(200, "one two three four five six seven eight nine ten")] * 50
    table = items_table(spark, items)
    blocks = list(decontam.item_blocks(table, 1000))
    assert sorted(name for block in blocks for name, _ in block) == sorted(str(n) for n, _ in set(items))
    assert max(len(block) for block in blocks) < 40
    given = [(1, f"a {items[-1][1]} b"), (2, items[5][1]), (3, "none")]
    got = decontam.digests(decontam.find_overlaps(docs(spark, given), table, block_bytes=1000))
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(given, items)


@pytest.mark.parametrize("bound", [decontam.BLOCK_BYTES])
def test_blocks_are_bounded(bound):
    assert bound <= 16 << 20
