import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from edge import LONG, ROWS, docs, empty
from pyspark.sql import functions as F

from pickwise.llm import token_counts
from pickwise.llm.queries import BYTE_BPE, op11_token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(BYTE_BPE)


def expected(library, doc_id, text):
    n = len(library.encode(text or "", add_special_tokens=False).ids)
    return (doc_id, len((text or "").encode()), n, n > 1024)


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_query_as_the_library(spark, sf_dir, library):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    same(op11_token_counts(spark, sf_dir).collect(), [expected(library, *row) for row in given])


def test_edge_rows(spark, library):
    rows = [*ROWS, (8, "a<|endoftext|>b <|endoftext|>"), (9, "<|endof"), (10, " leading and trailing "), (11, "a" * 50_000)]
    got = token_counts.limits(token_counts.count_tokens(docs(spark, rows), BYTE_BPE))
    same(got.collect(), [expected(library, *row) for row in rows])
    assert token_counts.count_tokens(empty(spark), BYTE_BPE).collect() == []


def test_only_misses_are_encoded(spark, tmp_path, library, monkeypatch):
    cache = token_counts.CountCache(spark, str(tmp_path / "cache"), BYTE_BPE)
    first = [(1, "one text"), (2, "one text"), (3, "two texts"), (4, None), (5, "")]
    second = [*first, (6, "three texts"), (7, "one text")]
    encoded = []
    plain = token_counts.encode
    monkeypatch.setattr(
        token_counts, "encode", lambda d, t: encoded.append([r.text for r in d.collect()]) or plain(d, t)
    )
    for rows in (first, second, second):
        got = token_counts.limits(token_counts.count_tokens(docs(spark, rows), BYTE_BPE, cache)).collect()
        same(got, [expected(library, *row) for row in rows])
    assert [sorted(x) for x in encoded] == [["", "one text", "two texts"], ["three texts"], []]
    assert cache.read().count() == 4


def test_counts_stored_twice_count_once(spark, tmp_path, library):
    cache = token_counts.CountCache(spark, str(tmp_path / "cache"), BYTE_BPE)
    token_counts.count_tokens(docs(spark, [(1, "some text")]), BYTE_BPE, cache)
    cache.append(cache.read())
    got = token_counts.limits(token_counts.count_tokens(docs(spark, [(1, "some text")]), BYTE_BPE, cache))
    same(got.collect(), [expected(library, 1, "some text")])


def test_another_tokenizer_has_counts_of_its_own(spark, tmp_path):
    folder, rows = str(tmp_path / "cache"), [(1, "some text, über"), (2, "")]
    token_counts.count_tokens(docs(spark, rows), BYTE_BPE, folder)
    got = token_counts.count_tokens(docs(spark, rows), PIECES, folder).collect()
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    same(got, [(i, len(t.encode()), len(pieces.encode(t))) for i, t in rows])
    assert token_counts.version(BYTE_BPE) != token_counts.version(PIECES)
    with pytest.raises(ValueError):
        token_counts.counter("vocabulary.txt")


def test_normalised_texts_share_a_count(spark, tmp_path):
    cache = token_counts.CountCache(spark, str(tmp_path / "cache"), BYTE_BPE)
    rows = [(1, "Text"), (2, "text"), (3, "TEXT")]
    token_counts.count_tokens(docs(spark, rows), BYTE_BPE, cache, F.lower)
    assert cache.read().count() == 1


def test_hot_text(spark, library, monkeypatch):
    from pickwise.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    rows = [(i, "copied text") for i in range(200)] + [(1000 + i, f"text {i}") for i in range(50)]
    got = token_counts.limits(token_counts.count_tokens(docs(spark, rows), BYTE_BPE))
    same(got.collect(), [expected(library, *row) for row in rows])


@pytest.mark.parametrize("text", [LONG[:5000], "a  b \n c 's 't d" * 300, "x<|endoftext|> y" * 200, "é " * 999, "ab" * 3000, " " * 4000])
def test_parts_have_as_many_tokens(library, text):
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for most in (1, 7, 100):
        parts = token_counts.parted(text, most)
        assert "".join(parts) == text and sum(map(count, parts)) == count(text)
