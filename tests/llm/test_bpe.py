import hashlib
import random
import tracemalloc

import pytest
import tokenizers
from edge import ROWS, docs, empty

from pickwise.llm import bpe
from pickwise.llm.queries import BYTE_BPE, op8_bpe


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(BYTE_BPE)


def expected(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(ids), digest(",".join(map(str, ids))), digest(decoded))


def test_random_texts_as_the_library(library):
    words = bpe.vocabulary(BYTE_BPE)
    rng = random.Random(3)
    alphabet = "ab  \n\t'stré1²€.!中\u200b\u0301😀" 
    for _ in range(2000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.2:
            text += "<|endoftext|>" + text
        assert words.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_certain(library):
    words = bpe.vocabulary(BYTE_BPE)
    data = "naïve\u0000\u00ffx".encode()
    assert b"".join(words.cut(data)) == data and len(words.cut(data)) > 1
    assert [len(x) for x in words.cut(b"hello")] == [5]


def test_long_run_without_cut(library):
    text = "a" * 50_000 + " " * 50_000
    assert bpe.vocabulary(BYTE_BPE).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_edge_rows(spark, library):
    got = bpe.digests(bpe.encode_decode(docs(spark, ROWS), BYTE_BPE)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(
        repr(expected(library, *row)) for row in ROWS
    )
    assert bpe.encode_decode(empty(spark), BYTE_BPE).count() == 0


def test_query_as_the_library(spark, sf_dir, library):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = op8_bpe(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(expected(library, *row) for row in given)


def test_every_code_point_as_the_library(library):
    """Next to letters, numbers, marks and an apostrophe; classes differ between Unicode versions."""
    words = bpe.vocabulary(BYTE_BPE)
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [
        "".join(f"a{chr(c)}1{chr(c)}.{chr(c)} '{chr(c)}'re" for c in codes[k : k + 4096])
        for k in range(0, len(codes), 4096)
    ]
    for text, ids in zip(texts, words.encode_all(texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["'꟎'re", "࢏b౜", "x\U000323b0're 1\U00011de0"])
def test_code_points_of_newer_versions(library, text):
    assert bpe.vocabulary(BYTE_BPE).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_fragments_merged_together_or_alone(library):
    words = bpe.vocabulary(BYTE_BPE)
    rng = random.Random(8)
    fragments = ["".join(rng.choice("aeinst zx1") for _ in range(rng.randint(1, 32))).encode() for _ in range(3000)]
    assert words.merge_all(fragments) == [words.merge(f) for f in fragments]


def test_known_fragments_take_little_memory():
    """A worker keeps its tables from task to task, beside all others of its executor."""
    words = bpe.vocabulary(BYTE_BPE)
    rng = random.Random(9)
    fragments = list({"".join(rng.choice("aeinstzx") for _ in range(12)).encode() for _ in range(5000)})
    tracemalloc.start()
    merged = words.merge_all(fragments)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert merged == [words.merge(f) for f in fragments]
    assert kept < 100 * len(fragments)
