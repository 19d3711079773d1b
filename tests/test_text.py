import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vectrail.functions import text
from vectrail.operators import search
from vectrail.sources.tables import load

# Query, mode, confidence.
MODES = [
    ("Python", "text", 0.8),
    ("test: debug performance", "text", 0.5),
    ("Machine learning", "text", 0.8),
    ("Comment fonctionne l'intelligence artificielle?", "hybrid", 0.5),
    ("Comment utiliser Docker?", "hybrid", 0.5),
    ("Quelle est la différence entre Python et JavaScript?", "hybrid", 0.9),
    ("Je veux apprendre le machine learning, par où commencer?", "hybrid", 0.9),
    ("AI", "text", 0.8),
    ("trois mots simples", "vector", 0.5),
    ("apprendre le machine learning", "vector", 0.7),
    ("", "text", 0.8),
]


def test_mode_and_confidence(spark):
    df = spark.createDataFrame([(q,) for q, _, _ in MODES], "query string")
    found = {r["query"]: r for r in search.analyse_queries(df).collect()}
    for query, mode, confidence in MODES:
        assert (found[query]["mode"], found[query]["confidence"]) == (mode, confidence), query
    assert found["Python"]["reasons"] == ["short query"]
    assert found["test: debug performance"]["reasons"] == ["test query"]
    # Reasons look at the raw text: a capital letter hides the question word.
    assert found["Comment utiliser Docker?"]["reasons"] == []


TEXTS = ["", "   ", "\t\n", "mot", "deux  mots", "Élève à l'école", "le la les de", "100%_sûr "]


def test_text_edges(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string")
    t = F.col("t")
    rows = df.select(
        "id",
        text.trim_all(t).alias("trimmed"),
        text.word_count(t).alias("n"),
        text.words(t).alias("words"),
        text.lexemes(t).alias("lex"),
    ).collect()
    assert [r["trimmed"] for r in rows] == [x.strip() for x in TEXTS]
    assert [r["n"] for r in rows] == [len(x.split(" ")) for x in TEXTS]
    assert rows[5]["words"] == ["élève", "à", "l", "école"]
    assert rows[6]["lex"] == []
    assert rows[7]["words"] == ["100", "sûr"]


def test_query_without_terms_matches_nothing(spark):
    df = spark.createDataFrame([(1, "le la les")], "id long, content string")
    assert search.text_search(df, "le la").count() == 0
    assert search.text_search(df, "  ").count() == 0


def test_all_terms_are_needed_and_copies_tie(spark):
    rows = [(1, "chat noir"), (2, "chats"), (3, "le chat et les chats noirs"), (4, "chat noir")]
    df = spark.createDataFrame(rows, "id long, content string")
    found = search.text_search(df, "Chat noir").collect()
    assert [r["id"] for r in found] == [3, 1, 4]
    assert found[0]["rank"] == pytest.approx((2 / 3 + 1 / 2) / 2)
    assert found[1]["rank"] == found[2]["rank"] == 0.5


def test_plural_forms(spark):
    words = ["bateaux", "bateau", "chevaux", "cheval", "grands", "grande", "aimer", "aimé"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    stems = {r["w"]: r["s"] for r in df.select("w", text.stem(F.col("w")).alias("s")).collect()}
    assert stems["bateaux"] == stems["bateau"] and stems["chevaux"] == stems["cheval"]
    assert stems["grands"] == stems["grande"] == "grand"


def python_stem(word, language):
    for pattern, replacement in text.stem_patterns(language):
        word = re.sub(pattern, lambda m: m.group(1) + replacement, word)
    return word


def python_forms(term, language):
    found = {term}
    for _, suffixes, replacement in reversed(text.STEM_RULES[language]):
        for word in list(found):
            if word.endswith(replacement):
                found |= {word[: len(word) - len(replacement)] + s for s in suffixes}
    return found


@pytest.mark.parametrize("language", list(text.STEM_RULES))
@settings(max_examples=300, deadline=None)
@given(word=st.text("aeiouylnrstxé", min_size=1, max_size=9))
def test_rules_keep_the_beginning_and_can_be_undone(language, word):
    term = python_stem(word, language)
    assert word.startswith(term[:-1])
    assert word in python_forms(term, language)


@pytest.mark.parametrize("language", list(text.STEM_RULES))
def test_word_forms_cover_the_corpus(spark, folder, language):
    words = (
        load(spark, folder, "documents")
        .select(F.explode(text.words(F.col("text"))).alias("w"))
        .filter(~F.col("w").isin(*text.stop_words(language)))
        .distinct()
        .withColumn("term", text.stem(F.col("w"), language))
    )
    covered = text.word_forms(words.select("term").distinct(), "term", "w", language)
    assert words.join(covered, ["w", "term"], "left_anti").count() == 0


def test_suggestions_keep_wildcards(spark):
    rows = [(1, "Alpha beta"), (2, "alpha BETA"), (3, "Alpha beta"), (4, "gamma")]
    df = spark.createDataFrame(rows, "id long, content string")
    found = [r["content"] for r in search.suggest(df, "a_b").collect()]
    assert found == ["Alpha beta", "alpha BETA"]
    assert search.suggest(df, "%").count() == 3


def test_labelled_text(spark):
    df = spark.createDataFrame([("x", None), (None, ""), (None, None)], "a string, b string")
    made = text.labelled([("", F.col("a")), ("B: ", F.col("b"))], F.lit("none"))
    assert [r[0] for r in df.select(made).collect()] == ["x", "none", "none"]
