"""Secrets in texts: exact base patterns, and every other candidate judged by a small network.

Candidates are the base spans (assignments to secret names, access keys, hex strings) and all
runs of at least ``LONG_TOKEN`` token characters, whatever they are made of, that base spans do not
cover entirely; base spans may lie inside or overlap them. The network of ``secret_model`` scores each with its surroundings; base spans stay whatever their score, others
become spans of kind ``token`` if their probability reaches the threshold, which was set to keep a
required share of the secrets in labelled findings, found through ``candidates``.

Null counts as an empty text without spans. Rows are independent, so repeated rows give repeated
results; an empty table gives no rows; other columns are ignored by ``find_secrets`` and kept by
``redact``. Work is linear in a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pickwise.llm.secret_model import Network, trained
from pickwise.llm.secret_spans import candidates
from pickwise.llm.tables import small_batches, span_columns, texts
from pickwise.llm.words import row_blocks

BASE_KINDS = ["assign", "access", "hex"]
FOUND = "array<struct<kind:string,start:long,end:long,base:boolean,score:double>>"
#: What a redacted span becomes.
MARK = "[SECRET]"


def scan(texts_: list[str | None], network: Network) -> list[list[dict]]:
    """The spans of each text with their scores."""
    found = [candidates(text or "") for text in texts_]
    flat = [(texts_[row], c[0], c[3]) for row, some in enumerate(found) for c in some]
    scores = iter(network.probabilities(flat).tolist() if flat else [])
    out = []
    for some in found:
        spans = []
        for start, _, kind, end in some:
            score, base = next(scores), kind in BASE_KINDS
            if base or score >= network.threshold:
                spans.append({"kind": kind, "start": start, "end": end, "base": base, "score": score})
        out.append(spans)
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``, the spans of each whole text in code points, end exclusive."""
    kind, network = docs.schema["doc_id"].dataType.simpleString(), trained()
    span = pa.struct(
        [
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
            ("base", pa.bool_()), ("score", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_blocks(batches, "text"):
            found = scan(batch.column("text").to_pylist(), network)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "found"]
            )

    return texts(docs).mapInArrow(run, f"doc_id {kind}, found {FOUND}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by ``MARK``; overlapping spans become one mark.

    Texts without secrets, null ones included, stay as they are.
    """
    network = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_blocks(batches, "text"):
            column = batch.column("text")
            new = column.to_pylist()
            for row, spans in enumerate(scan(new, network)):
                text, kept, at = new[row], [], 0
                for x in spans:
                    if x["start"] >= at:
                        kept += [text[at : x["start"]], MARK]
                    at = max(at, x["end"])
                if spans:
                    new[row] = "".join([*kept, text[at:]])
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, column.type) if c == "text" else batch.column(c) for c in names], names
            )

    return small_batches(docs).mapInArrow(run, docs.schema)


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, and the spans as text."""
    return found.select("doc_id", *span_columns(BASE_KINDS))
