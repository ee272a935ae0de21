import random
import re

from check import compare, compare_types, connect

from pickwise.llm import chat
from pickwise.llm.queries import ORACLE_SQL, op2_chat

SCHEMA = "conv_id long, turn int, role string, text string, chosen string, prompt string, pair_id string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows):
    sides = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            sides.setdefault(conv, set()).add((turn is not None, turn or 0, role or "unknown", text or ""))
    out = []
    for pair in {conv // 2 for conv in sides}:
        both = [
            [x[2:] for x in sorted(sides[c])] if c in sides else None for c in (2 * pair, 2 * pair + 1)
        ]
        n = 0
        while all(s and n < len(s) for s in both) and both[0][n] == both[1][n]:
            n += 1
        line = lambda r, t: f"<|im_start|>{r}\n{t}<|im_end|>\n"
        mask = lambda r, t: "0" * (13 + len(r)) + ("1" if r == "assistant" else "0") * (len(t) + 11)
        row = [pair, *(c if c in sides else None for c in (2 * pair, 2 * pair + 1)), n]
        row.append("".join(line(*x) for x in (both[0] or [])[:n]))
        for side in both:
            row += [None if side is None else "".join(f(*x) for x in side[n:]) for f in (line, mask)]
        out.append(tuple(row))
    return sorted(out)


def test_pairs_by_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(200):
        for turn in range(rng.randint(0, 6)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn, role, rng.choice(["a", "a", "a", "é😀"])))
    rows += [
        (None, 0, "user", "x"), (400, None, None, None), (400, 1, "assistant", None), (401, None, None, ""),
        (401, 1, "assistant", "b"), (500, 0, "user", "same"), (501, 0, "user", "same"), (-3, 0, "user", "q"),
        (600, 0, "user", "long " * 50_000), *rows[:40],
    ]
    got = chat.neighbour_pairs(turns(spark, rows))
    found = sorted((tuple(r) for r in got.collect()), key=lambda r: r[0])
    assert found == brute(rows)
    assert any(r[3] for r in found) and all(len(r[5] or "") == len(r[6] or "") for r in found)


def test_empty_table(spark):
    assert chat.neighbour_pairs(turns(spark, [])).count() == 0


def test_native(spark, sf_dir):
    plan = op2_chat(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_matches_sql(spark, sf_dir):
    connection = connect(sf_dir)
    df = op2_chat(spark, sf_dir)
    assert compare(df, connection, ORACLE_SQL["op2_chat"]) == []
    assert compare_types(df, connection, ORACLE_SQL["op2_chat"]) == []
