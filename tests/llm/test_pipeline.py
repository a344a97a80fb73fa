"""The pipeline's stages, one after the other, against plain versions."""

from __future__ import annotations

import base64
import struct
from collections import Counter

import duckdb
import public_tokenizers
import tiktoken

import corpus_pipeline
from evenhand.llm.common import written
from evenhand.llm.queries import ORACLES, QUERIES
from evenhand.llm.statements import MIXING_SQL
from tests.llm import brute
from tests.llm.test_selection import brute_language


def test_stages_on_a_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id % 2 = 0")
    columns = docs.columns
    functions = dict(corpus_pipeline.STAGES)

    known = written(functions["language"](spark, docs, sf), "test")
    assert known.columns == columns and known.count() >= 0.97 * docs.count()
    answers = brute_language([(r.doc_id, r.text, r.lang) for r in docs.collect()])
    expected = [r.doc_id for r, (lang, score) in zip(docs.collect(), answers) if lang != "und" and score >= 0.4]
    assert sorted(r.doc_id for r in known.collect()) == sorted(expected)

    single = written(functions["near_copies"](spark, known, sf), "test")
    before = [(r.doc_id, r.text) for r in known.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in brute.jaccard_components(before)})

    clean = written(functions["repeated_passages"](spark, single, sf), "test")
    assert clean.columns == columns
    texts = {r.doc_id: r.text for r in single.collect()}
    gone = {d: (n, r) for d, n, r, _, _ in brute.passages(list(texts.items()))}
    left = {r.doc_id: r.text for r in clean.collect()}
    assert set(left) == {d for d, (n, r) in gone.items() if r < n or n == 0}
    assert all(left[d] == texts[d] for d in left if gone[d][1] == 0)

    mixed = written(functions["mix"](spark, clean, sf), "test")
    assert mixed.columns == columns and 0.5 * clean.count() < mixed.count() < 2.5 * clean.count()
    con = duckdb.connect()
    con.register("documents", clean.toArrow())
    result = con.execute(MIXING_SQL)
    names = [d[0] for d in result.description]
    copies = Counter()
    for row in (dict(zip(names, r)) for r in result.fetchall()):
        if row["size"]:
            copies[row["doc_id"]] += row["taken"] // row["size"]
    assert Counter(r.doc_id for r in mixed.collect() if brute.words(r.text)) == +copies

    ids = functions["token_ids"](spark, mixed, sf)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted((r.doc_id, struct.pack(f"<{len(own)}I", *own)) for r in mixed.collect() for own in [library.encode_ordinary(r.text or "")])
    assert sorted((r.doc_id, bytes(r.ids)) for r in ids.collect()) == expected


def test_stages_bear_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
        if "text" not in docs.columns:
            break


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
