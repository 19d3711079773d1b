"""The registered queries against their SQL, and the pipeline against a plain version."""

import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from tests.llm.test_texts import plain_components, plain_line_dedup
from tests.oracle import compare
from vectrail.llm import simhash
from vectrail.llm.queries import LLM_ORACLES, LLM_QUERIES
from vectrail.session import work_path
from vectrail.sources.tables import load, write_table

import numpy as np

# Type names that tests.oracle does not know of.
KEYS = {f"op{n}_" for n in range(1, 14)}


def test_every_operator_has_its_query():
    names = entry_module.queries()
    assert all(any(n.startswith(k) for n in names) for k in KEYS) and "pipeline" in names
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_against_sql(spark, folder, duck, name):
    _, fault = compare(LLM_QUERIES[name](spark, folder), duck, LLM_ORACLES[name])
    assert fault is None


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLES) - {"pipeline"}))
def test_query_gives_a_row_per_document(spark, folder, name):
    df = LLM_QUERIES[name](spark, folder)
    assert sorted(r["doc_id"] for r in df.select("doc_id").collect()) == sorted(
        r["doc_id"] for r in load(spark, folder, "documents").select("doc_id").collect()
    )
    if "held_out" in df.columns:
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in df.collect())


def test_pipeline_stages(spark, folder):
    docs = load(spark, folder, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = write_table(stage(spark, docs, folder), work_path(spark, "stage"))
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    first = {r["doc_id"]: r for r in kept["language_id"]}
    assert len(first) >= 0.98 * load(spark, folder, "documents").count()
    want = plain_line_dedup([(r["doc_id"], r["text"]) for r in kept["language_id"]], corpus_pipeline.MIN_DOCS, False)
    assert Counter((r["doc_id"], r["text"]) for r in kept["line_dedup"]) == Counter((w[0], w[3]) for w in want.elements())
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"])
    prints = np.array([simhash.fingerprint(r["text"].encode()) for r in kept["line_dedup"]], np.uint64)
    names = plain_components(prints, [r["doc_id"] for r in kept["line_dedup"]], 4)
    assert {r["doc_id"] for r in kept["simhash_near_dedup"]} == set(names)
    assert len(kept["simhash_near_dedup"]) == len(set(names))
    copies = Counter(r["doc_id"] for r in kept["source_mixing"])
    assert max(copies.values()) <= 2 and set(copies) <= set(names)
    last = kept["bpe_tokens"]
    assert Counter(r["doc_id"] for r in last) == copies and all(r["round_trip"] for r in last)


def test_pipeline_on_hard_rows(spark, hard, nothing, folder):
    for docs in (hard, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = write_table(stage(spark, docs, folder), work_path(spark, "stage"))
        docs.collect()


def test_run_is_what_the_stages_give(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
