"""Language ID, toxicity and quality: model checks, held-out accuracy, hard rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import DOCUMENTS, document, hard_documents
from vectrail.llm import langid, quality, toxicity
from vectrail.llm.texts import pieces, third
from vectrail.sources.tables import load


def test_held_out_rows_are_those_of_crc32(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id long").select("doc_id", third("doc_id")).collect()
    assert all(r[1] == (0 if r[0] is None else zlib.crc32(str(r[0]).encode()) % 3) for r in rows)


def test_pieces_lose_nothing():
    text = b"ab cd\tef " * 1000
    assert b"".join(b" ".join(pieces(text, 100)).split()) == b"".join(text.split())
    assert list(pieces(b"x" * 500, 100)) == [b"x" * 500]


# ----------------------------------------------------------------- language ID


def plain_probability(counts, gram):
    """Interpolated Kneser-Ney by its definition, for one language."""
    alphabet = {c for g in counts for c in g}
    tables = [None, None, None, None, counts]
    for size in (3, 2, 1):
        tables[size] = Counter(g[1:] for g in tables[size + 1])

    def p(text):
        if not text:
            return 1 / (len(alphabet) + 1)
        of = tables[len(text)]
        once, twice = (sum(1 for n in of.values() if n == k) for k in (1, 2))
        discount = min(0.95, max(0.1, once / (once + 2 * twice) if once + twice else 0.5))
        same = {g: n for g, n in of.items() if g[:-1] == text[:-1]}
        if not same:
            return p(text[1:])
        total = sum(same.values())
        return max(of.get(text, 0) - discount, 0) / total + discount * len(same) / total * p(text[1:])

    return p(gram)


def test_kneser_ney_against_its_definition():
    words = "the then there that this tree three der die das dem den".split()
    counts = {}
    for language, some in (("x", words[:7]), ("y", words[7:])):
        counts[language] = Counter()
        for word in some:
            padded = langid.START * 3 + word + langid.END
            counts[language].update(padded[i : i + 4] for i in range(len(word) + 1))
    model = langid.kneser_ney(counts)
    # The uniform share is over the letters of all languages.
    letters = {c for of in counts.values() for g in of for c in g}
    for word in ["the", "den", "zebra", "treeder"]:
        got = model.word_scores([word])[0]
        for column, language in enumerate(("x", "y")):
            padded = langid.START * 3 + word + langid.END
            own = {c for g in counts[language] for c in g}
            want = 0.0
            for i in range(len(word) + 1):
                want += math.log(plain_probability(counts[language], padded[i : i + 4]))
            if own == letters:
                assert got[column] == pytest.approx(want, rel=1e-4)
            else:
                assert got[column] <= want + 1e-3
    total = sum(math.exp(model.word_scores([w])[0][0]) for w in words[:7])
    assert 0 < total < 1


def test_language_id_on_held_out_documents(spark, folder):
    documents = load(spark, folder.replace("0.001", "0.01"), "documents")
    found = langid.identify(documents).select("doc_id", "lang", "_lang_pred", "_lang_rejected").collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum(r["lang"] == r["_lang_pred"] for r in held) >= 0.99 * len(held)
    assert sum(r["_lang_rejected"] for r in found) <= 0.01 * len(found)


def test_language_id_on_hard_rows(hard, spark):
    found = langid.identify(hard).select("doc_id", "text", "_lang_pred", "_lang_score", "_lang_rejected").collect()
    assert len(found) == len(hard_documents())
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["_lang_pred"] == "und") == (not letters)
        assert 0 <= r["_lang_score"] <= 1
        if not letters:
            assert r["_lang_rejected"]


def test_noise_is_rejected_and_clean_texts_stay(spark, folder):
    documents = load(spark, folder.replace("0.001", "0.01"), "documents").select("doc_id", "text", "lang")
    noise = [(10**6 + i, " ".join("xqzjvwkpfg"[j % 10] * (1 + j * i % 7) + "qxzjk" for j in range(80)), None) for i in range(20)]
    mixed = documents.unionByName(spark.createDataFrame(noise, documents.schema))
    found = langid.identify(mixed).select("doc_id", "_lang_rejected").collect()
    assert all(r["_lang_rejected"] for r in found if r["doc_id"] >= 10**6)
    assert sum(r["_lang_rejected"] for r in found if r["doc_id"] < 10**6) <= 10


def test_noise_with_a_language_is_rejected(spark, folder):
    documents = load(spark, folder.replace("0.001", "0.01"), "documents").select("doc_id", "text", "lang")
    draw = np.random.default_rng(11)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    noise = [(10**6 + i, " ".join("".join(draw.choice(letters, draw.integers(3, 9))) for _ in range(150)), "en") for i in range(30)]
    found = langid.identify(documents.unionByName(spark.createDataFrame(noise, documents.schema)))
    found = found.select("doc_id", "_lang_rejected").collect()
    assert all(r["_lang_rejected"] for r in found if r["doc_id"] >= 10**6)
    assert sum(r["_lang_rejected"] for r in found if r["doc_id"] < 10**6) <= 10


def test_limits_of_thin_classes_and_languages():
    classes = [("en", 5, 500, 2.0, 2.2), ("en", 8, 500, 1.4, 1.41), ("en", 6, 3, 9.0, 9.9), ("ja", 8, 400, 4.0, 4.1), ("fr", 8, 20, 1.0, 1.0)]
    limit = {(a, b): c for a, b, c in langid.limits_of(classes, 8, 1.1)}
    assert limit["en", 5] == limit["en", 6] == limit["en", 0] == pytest.approx(1.1 * (2 + 8 * 0.2 / 0.6745))
    assert limit["en", 8] == limit["en", 7] == limit["en", 12] == pytest.approx(1.1 * (1.4 + 8 * 0.07))
    assert limit["ja", 8] > 2 * limit["en", 8] and limit["en", 8] < limit["fr", 8] < limit["ja", 8]
    assert langid.limits_of(classes[2:3], 8, 1.1) == []


def test_language_id_without_anything_to_learn(spark, nothing):
    assert langid.identify(nothing).count() == 0
    unknown = spark.createDataFrame([document(1, "some text", None), document(2, None, None)], DOCUMENTS)
    rows = langid.identify(unknown).collect()
    assert {(r["_lang_pred"], r["_lang_score"], r["_lang_rejected"]) for r in rows} == {("und", 0.0, True)}


def test_all_ngrams_are_learnt_with_many_languages(spark):
    # 250 values of lang; 40,000,000 / 250^2 = 640 n-grams would be kept of a language that has more.
    draw = np.random.default_rng(3)
    words = ["".join(draw.choice(list("abcdefghijklmnop"), 6)) for _ in range(400)]
    rows = [(i, w, "big") for i, w in enumerate(words)] + [(1000 + i, "ab", f"l{i % 249}") for i in range(996)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    counts = {}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 3 != 1:
            padded = langid.START * 3 + text + langid.END
            counts.setdefault(lang, Counter()).update(padded[j : j + 4] for j in range(len(text) + 1))
    assert len(model.languages) == len(counts) > 100 and len(counts["big"]) > 640
    assert model.grams[3].dense is None  # entries only where there is an n-gram
    column = model.languages.index("big")
    for word in [*words[:3], "zab"]:
        padded = langid.START * 3 + word + langid.END
        want = sum(math.log(plain_probability(counts["big"], padded[j : j + 4])) for j in range(len(word) + 1))
        assert model.word_scores([word])[0][column] == pytest.approx(want, rel=1e-4)


# ------------------------------------------------------------------- toxicity


def _abusive(spark, n=600):
    """Texts of random syllables; every third holds invented abuse here and there."""
    draw = np.random.default_rng(7)
    syllables = ["ta", "re", "mo", "li", "ka", "su", "ne", "vi", "do", "pe", "shi", "ran", "tel"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(draw.choice(syllables, draw.integers(1, 4))) for _ in range(draw.integers(30, 120))]
        if i % 3 == 0:
            for j in range(0, len(words), 12):
                words[j] = str(draw.choice(["grumblewort", "Fopdoodle", "zounderkite", "muckspout"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_texts(spark):
    documents, labels = _abusive(spark)
    model = toxicity.fit(documents, labels)
    rows = toxicity.score(documents, model).join(labels.withColumnRenamed("doc_id", "_id"), "_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["_id"]).encode()) % 3 == 1]
    right = sum((r["score"] >= 0.7) == (r["toxic"] == 1) for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_looked_at(spark):
    documents, labels = _abusive(spark, 150)
    flipped = labels.withColumn("toxic", (third("doc_id") == 1).cast("int").bitwiseXOR(labels["toxic"]))
    a, b = (toxicity.fit(documents, x) for x in (labels, flipped))
    assert a.toxic == b.toxic and a.ordinary == b.ordinary and np.array_equal(a.weights, b.weights)


def test_toxicity_on_hard_rows(spark, hard, nothing):
    documents, labels = _abusive(spark, 150)
    model = toxicity.fit(documents, labels)
    found = toxicity.score(hard, model).collect()
    assert len(found) == len(hard_documents())
    assert {r["score"] for r in found if r["_id"] in (100, 101, 102)} == {0.0}
    assert len({r["score"] for r in found if r["_id"] == 108}) == 1
    assert toxicity.score(nothing, model).count() == 0
    blank = toxicity.fit(nothing, labels)
    assert {r["score"] < 0.01 for r in toxicity.score(hard, blank).collect()} == {True}


def test_windows_cover_the_whole_text():
    text = hard_documents()[27][1].encode()
    assert len(text) > 1 << 20
    assert b"".join(b"".join(toxicity.windows(text)).split()) == b"".join(text.lower().split())
    assert max(map(len, toxicity.windows(b"z" * 10_000))) <= toxicity.LONGEST


# -------------------------------------------------------------------- quality


def test_ordinal_regression_with_four_grades(spark):
    draw = np.random.default_rng(3)
    rows, grades = [], []
    for i in range(900):
        grade = i % 4
        # The share of "good" words rises with the grade.
        words = [str(draw.choice(["alpha", "beta"])) if draw.random() < 0.15 + 0.22 * grade else "##%%" for _ in range(80)]
        rows.append((i, " ".join(words)))
        grades.append((i, grade + 10))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame(grades, "doc_id long, quality int")
    model = quality.fit(documents, ratings)
    assert model.grades.tolist() == [10, 11, 12, 13] and (np.diff(model.thresholds) > 0).all()
    found = quality.score(documents, model).collect()
    held = [r for r in found if zlib.crc32(str(r["_id"]).encode()) % 3 == 1]
    error = np.mean([abs(r["expected_grade"] - (r["_id"] % 4 + 10)) for r in held])
    assert error < 0.45
    for r in found:
        assert all(a >= b for a, b in zip(r["reach"], r["reach"][1:]))


def test_gradient_against_differences():
    rows = np.array([0, 0, 1, 2, 2, 3, 4, 5])
    columns = np.array([1, 2, 2, 3, 1, 3, 2, 1])
    shares = np.array([0.5, 0.5, 1, 0.7, 0.3, 1, 1, 1])
    model = quality.fit_ordinal(rows, columns, shares, np.array([0, 1, 2, 2, 1, 0]), steps=400, ridge=1e-3)
    p = model.reach(np.array([0.0]))[0]
    assert 0 < p[1] < p[0] < 1


def test_quality_on_documents_and_hard_rows(spark, folder, hard, nothing):
    at = folder.replace("0.001", "0.01")
    documents, labels = load(spark, at, "documents"), load(spark, at, "labels")
    model = quality.fit(documents, labels)
    rows = quality.score(documents, model).join(labels.withColumnRenamed("doc_id", "_id"), "_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["_id"]).encode()) % 3 == 1]
    good = [r["reach"][-1] >= 0.5 for r in held if r["quality"] == 1]
    bad = [r["reach"][-1] >= 0.5 for r in held if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)
    found = quality.score(hard, model).collect()
    assert len(found) == len(hard_documents()) and all(0 <= r["expected_grade"] <= 1 for r in found)
    assert quality.score(nothing, model).count() == 0
    one = quality.fit(documents, labels.filter("quality = 1"))
    assert {r["expected_grade"] for r in quality.score(hard, one).collect()} == {1.0}
    none = quality.fit(nothing, labels)
    assert {r["expected_grade"] for r in quality.score(hard, none).collect()} == {0.0}


def test_scores_against_a_plain_rescoring(spark):
    """Every score again from the two dictionaries, without Spark and without remembering anything."""
    import zstandard

    documents, labels = _abusive(spark, 300)
    model = toxicity.fit(documents, labels)
    form = zstandard.ZstdCompressionParameters(**toxicity._FORMAT)
    packs = [
        zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=form)
        for d in (model.ordinary, model.toxic)
    ]
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in toxicity.score(documents, model).collect():
        saved = []
        for word in texts[r["_id"]].lower().encode().split():
            whole = b" " + word + b"  " + word + b" " + toxicity.CLOSE
            saved.append(len(packs[0].compress(whole)) - len(packs[1].compress(whole)))
        evidence = sum(max(0, s - model.step + 1) for s in saved) / math.log(len(saved) + 3)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(evidence * model.weights[1] + model.weights[0]))))
        assert (r["n_windows"], r["largest_saving"]) == (len(saved), max(max(saved), 0))


def test_common_windows_stay_out_of_the_toxic_dictionary(spark):
    documents, labels = _abusive(spark)
    model = toxicity.fit(documents, labels)
    saving = model.savings()
    assert min(saving[w] for w in (b"grumblewort", b"fopdoodle", b"zounderkite", b"muckspout")) >= model.step
    assert max(saving[w] for w in (b"tare", b"mo", b"likasu")) < model.step
