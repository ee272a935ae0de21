import hashlib

import corpus_pipeline
import tokenizers
from edge import ROWS, docs, empty, with_own_names
from test_decontam import split
from test_minhash import brute as duplicate_groups
from test_secrets import brute as secret_spans

from pickwise.llm import decontam, quality
from pickwise.llm.queries import BYTE_BPE


def run_stages(spark, table, sf_dir, upto=5):
    for _, stage in corpus_pipeline.STAGES[:upto]:
        table = stage(spark, table, sf_dir)
    return table


def test_stages_by_brute_force(spark, sf_dir):
    """Each stage on what the one before kept, by its definition."""
    kept = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = kept.columns
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, sf_dir)
        if name != "encode":
            assert kept.columns == columns
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        outputs.append({r.doc_id: r for r in kept.collect()})
    given = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    good = {
        r.doc_id
        for r in quality.assess(spark.read.parquet(f"{sf_dir}/documents.parquet")).filter("kept").collect()
    }
    first, unique, clean, redacted, encoded = outputs
    assert set(first) == good and all(first[n] == given[n] for n in first)
    groups = duplicate_groups([(n, r.text) for n, r in first.items()])
    assert sorted(unique) == sorted(int(x[1:].split(",")[0]) for x in groups if x.endswith("True)"))
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = {tuple(w[a : a + 10]) for w in map(split, items) for a in range(len(w) - 9)}
    for doc_id, row in unique.items():
        words = split(row.text)
        hit = {a + k for a in range(len(words) - 9) if tuple(words[a : a + 10]) in windows for k in range(10)}
        if len(hit) > decontam.MAX_COVERAGE * len(words):
            assert doc_id not in clean
        else:
            assert split(clean[doc_id].text) == [w for n, w in enumerate(words) if n not in hit]
            assert hit or clean[doc_id] == row
    assert set(redacted) == set(clean)
    for doc_id, row in clean.items():
        if not secret_spans(row.text):
            assert redacted[doc_id].text == row.text
        assert secret_spans(redacted[doc_id].text) == []
    library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    for doc_id, row in redacted.items():
        ids = library.encode(row.text, add_special_tokens=False).ids
        assert tuple(encoded[doc_id]) == (
            doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(row.text.encode()).hexdigest(),
        )
    assert len(encoded) == len(redacted)


def test_edge_rows(spark, sf_dir):
    assert run_stages(spark, empty(spark), sf_dir).count() == 0
    longer = [(n, text and f"{text} {' '.join(f'{text[:3]}{k}' for k in range(30))}") for n, text in ROWS]
    table = docs(spark, longer)
    assert run_stages(spark, table, sf_dir, 4).columns == table.columns


def test_columns_with_the_stages_own_names(spark, sf_dir):
    """Columns named like those inside a stage come through with their values, and change no decision."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 60")
    for name, stage in corpus_pipeline.STAGES[:4]:
        more = with_own_names(table)
        got = stage(spark, more, sf_dir)
        assert got.columns == more.columns, name
        expected = with_own_names(stage(spark, table, sf_dir))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect())), name


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
