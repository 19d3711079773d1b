"""Columns whose names the operators use themselves, archives read with other splits, searches that don't settle."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vectrail.llm import bpe, langid, line_dedup, mixing, simhash, toxicity, warc
from vectrail.llm.queries import tokenizer_path
from vectrail.llm.texts import free_prefix
from vectrail.session import work_path
from vectrail.sources.tables import write_table

OWN = [
    "_lang_pred", "_lang_rejected", "_lang_of", "_LANG_entropy", "_line_dedup_n", "_line_dedup_text", "_line_dedup__map",
    "_mix_size", "_mix_copies", "_mix_i", "_mix__target", "_id", "_fp", "_row", "_text", "_source", "_size", "_mark", "token", "kept",
]


@pytest.fixture(scope="module")
def clashing(hard):
    for i, name in enumerate(OWN):
        hard = hard.withColumn(name, F.lit(f"own {i}"))
    return hard


def same_payload(rows, count):
    assert len(rows) == count and all(r[name] == f"own {i}" for r in rows for i, name in enumerate(OWN))


def test_free_prefix(clashing, nothing):
    assert free_prefix(nothing, "_mix") == "_mix"
    assert free_prefix(clashing, "_mix") == "_mix___" and free_prefix(clashing, "_lang") == "_lang__"


@pytest.mark.parametrize("empty", [False, True])
def test_operators_keep_columns_with_their_own_names(clashing, empty):
    df = clashing.limit(0) if empty else clashing
    n = df.count()
    path = tokenizer_path()
    same_payload(line_dedup.drop_repeated_lines(df, 10).collect(), n)
    same_payload(langid.identify(df).collect(), n)
    same_payload(mixing.mix(df).collect(), n)
    same_payload(bpe.encode_and_decode(df, path).collect(), n)
    assert simhash.near_duplicates(df).count() == n
    kept = simhash.one_of_each(df).collect()
    same_payload(kept, len(kept))
    assert toxicity.score(df, toxicity.fit(df, df.select("doc_id", F.lit(1).alias("toxic")))).count() == n


def test_clashing_names_change_no_result(spark, hard, clashing):
    for run, columns in (
        (lambda df: line_dedup.drop_repeated_lines(df, 10), ("text", "lines", "dropped")),
        (mixing.mix, ("size", "target", "copies")),
    ):
        prefix = "_line_dedup" if columns[0] == "text" else "_mix"
        plain = run(hard).select("doc_id", *[f"{prefix}_{c}" for c in columns])
        other = free_prefix(clashing, prefix)
        found = run(clashing).select("doc_id", *[f"{other}_{c}" for c in columns])
        assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, found.collect()))


def test_pipeline_stages_keep_them_too(spark, clashing, folder):
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = write_table(stage(spark, docs, folder), work_path(spark, "stage"))
        assert docs.columns == clashing.columns
        rows = docs.collect()
        same_payload(rows, len(rows))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_archives_do_not_depend_on_the_splits(spark):
    """The same records whatever the splits are, also if they change between planning and reading."""
    rows = [(i, f"http://a/{i}", None if i % 50 == 7 else f"<p>{'x' * (i % 97)}{i % 40}</p>" * (i % 23)) for i in range(700)]
    rows.append((9999, "http://a/trap", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = work_path(spark, "warc")
    warc.write_warc(pages.repartition(2), path)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    found = []
    try:
        for planned, read in (("128m", "128m"), ("3k", "3k"), ("128m", "2k"), ("2k", "128m")):
            spark.conf.set(size, planned)
            records = warc.page_records(spark, path)
            spark.conf.set(size, read)
            found.append(Counter(map(tuple, records.collect())))
    finally:
        spark.conf.set(size, before)
    assert sum(found[0].values()) == len(rows) and all(f == found[0] for f in found)


def test_a_mix_that_does_not_settle_is_an_error(spark, hard):
    sizes = [("a", s, n) for s, n in ((1, 50), (7, 9), (900, 3), (100_000, 2))]
    histogram = spark.createDataFrame(sizes, "_source string, _size long, _n long")
    sums = histogram.groupBy("_source").agg(F.sum(F.col("_n") * F.col("_size")).alias("_size_sum"))
    goals = mixing.targets(sums)
    with pytest.raises(RuntimeError, match="did not settle"):
        mixing.balance(histogram, goals, 2, max_steps=1)
    assert mixing.balance(histogram, goals, 2).filter("_open").count() == 0


def test_a_mix_settles_by_halving_alone(spark, monkeypatch):
    monkeypatch.setattr(mixing, "NEWTON_STEPS", 0)
    histogram = spark.createDataFrame([("a", 3, 40), ("a", 50, 7), ("b", 10, 10)], "_source string, _size long, _n long")
    sums = histogram.groupBy("_source").agg(F.sum(F.col("_n") * F.col("_size")).alias("_size_sum"))
    assert mixing.balance(histogram, mixing.targets(sums), 2).filter("_open").count() == 0
