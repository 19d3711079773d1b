"""Text functions: lexing, light stemming, matching, ranking and query routing.

Words are runs of letters and digits in lower case.  A *term* is a word that is
not a stop word, cut by a few suffix rules per language (light stemming in the
manner of Harman 1991 and Savoy 1999).
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Mapping, Sequence
from functools import lru_cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffix rules (what must stand before, suffixes, replacement),
# applied in this order.  No rule touches more than the last letter of its
# result, so a term without its last letter always begins the word it came from.
STEM_RULES = {
    "french": (
        (".+", ("eaux",), "eau"),
        (".{2,}", ("aux",), "al"),
        (".{3,}", ("s", "x"), ""),
        (".{4,}", ("r",), ""),
        (".{3,}", ("e",), ""),
        (".{3,}", ("é",), ""),
    ),
    "english": (
        (".*[^ea]", ("ies",), "y"),
        (".*[^aeo]", ("es",), "e"),
        (".*[^us]", ("s",), ""),
    ),
    "german": ((".{4,}?", ("ern", "em", "en", "er", "es", "e", "n", "s"), ""),),
    "spanish": ((".{3,}?", ("es", "s"), ""), (".{3,}", ("a", "e", "o"), "")),
}


def stem_patterns(language: str) -> list[tuple[str, str]]:
    """The suffix rules as (pattern with one group, text after the group)."""
    return [
        (f"^({before})(?:{'|'.join(suffixes)})$", replacement)
        for before, suffixes, replacement in STEM_RULES[language]
    ]


# Ranks that are equal in exact arithmetic tie after this rounding.
RANK_DECIMALS = 12

WORD_GAP = r"[^\p{L}\p{N}]+"

# Every white-space character, the line ends and wide spaces included.
SPACES = (
    "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)


@lru_cache(maxsize=None)
def stop_words(language: str = "french") -> tuple[str, ...]:
    """The stop words Spark ships for a language."""
    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def trim_all(text: Column) -> Column:
    """Cut white space of every kind from both ends."""
    return F.btrim(text, F.lit(SPACES))


def word_count(text: Column) -> Column:
    """Pieces between single spaces; a doubled space counts an empty piece."""
    return F.size(F.split(text, " ", -1))


def words(text: Column) -> Column:
    """Lower-case words in order of appearance."""
    return F.filter(F.split(F.lower(text), WORD_GAP), lambda w: w != "")


def stem(word: Column, language: str = "french") -> Column:
    """Cut the suffixes of one word."""
    for pattern, replacement in stem_patterns(language):
        word = F.regexp_replace(word, pattern, f"$1{replacement}")
    return word


def forms(term: Column, language: str = "french") -> Column:
    """Every word that can have this term, found by undoing the suffix rules.

    Some entries may have another term; check them with ``stem``.
    The number of entries depends on the rules alone, not on the texts.
    """
    found = F.array(term)
    for _, suffixes, replacement in reversed(STEM_RULES[language]):
        found = F.flatten(F.transform(found, _undo(suffixes, replacement)))
        found = F.filter(found, lambda word: word.isNotNull())
    return F.array_distinct(found)


def _undo(suffixes: Sequence[str], replacement: str):
    def longer(word: Column) -> Column:
        kept = F.substring(word, F.lit(1), F.char_length(word) - len(replacement))
        cut = word.endswith(replacement)
        return F.array(word, *[F.when(cut, F.concat(kept, F.lit(s))) for s in suffixes])

    return longer


def word_forms(terms: DataFrame, term: str, word: str, language: str = "french") -> DataFrame:
    """Add ``word``: one row per word that has the term and is no stop word.

    Lexing a large corpus for given terms is then a join on the plain word;
    no suffix rule runs on the corpus.
    """
    return terms.withColumn(word, F.explode(forms(F.col(term), language))).filter(
        ~F.col(word).isin(*stop_words(language))
        & (stem(F.col(word), language) == F.col(term))
    )


def lexemes(text: Column, language: str = "french") -> Column:
    """Terms of a text in order, repeats kept."""
    stops = list(stop_words(language))
    return F.transform(F.filter(words(text), lambda w: ~w.isin(stops)), lambda w: stem(w, language))


def query_terms(query: Column, language: str = "french") -> Column:
    """Distinct terms of a query, sorted."""
    return F.sort_array(F.array_distinct(lexemes(query, language)))


def matches(doc_lexemes: Column, terms: Column) -> Column:
    """Every term occurs; a query without terms matches nothing."""
    return (F.size(terms) > 0) & F.forall(terms, lambda t: F.array_contains(doc_lexemes, t))


def rank(doc_lexemes: Column, terms: Column) -> Column:
    """Mean over the terms of ``tf / (tf + 1)``, in [0.5, 1) on a match.

    Term-frequency saturation after Robertson and Walker (1994), k1 = 1, b = 0.
    """
    shares = F.transform(
        terms, lambda t: saturation(F.size(F.filter(doc_lexemes, lambda w: w == t)))
    )
    total = F.aggregate(shares, F.lit(0.0), lambda acc, x: acc + x)
    return F.round(F.try_divide(total, F.size(terms).cast("double")), RANK_DECIMALS)


def word_codes(texts: Column, dims: int) -> Column:
    """Twice the slot of every word of a text, plus one for a negative sign; both from its MD5 digest.

    Worked out in the JVM: the first four bytes give the slot, the fifth the sign.
    """
    words = F.filter(F.split(F.lower(texts), WORD_GAP), lambda w: w != "")
    digests = F.transform(words, lambda w: F.md5(w.cast("binary")))

    def code(digest: Column) -> Column:
        slot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % dims
        return slot * 2 + F.when(F.substring(digest, 9, 1) < "8", 0).otherwise(1)

    return F.transform(digests, code)


def drawer(term: Column) -> Column:
    """Which of the small maps of a text holds the count of a term."""
    return F.pmod(F.hash(term), F.lit(64))


def rank_of_counts(drawers: Column, terms: Column) -> Column:
    """``rank`` from counts kept by drawer and term; NULL when a term is absent."""

    def count(term: Column) -> Column:
        return F.try_element_at(F.try_element_at(drawers, drawer(term)), term)

    total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + saturation(count(t)))
    return F.round(F.try_divide(total, F.size(terms).cast("double")), RANK_DECIMALS)


def saturation(tf: Column) -> Column:
    """``tf / (tf + 1)``, written so that the count is worked out once."""
    return F.lit(1.0) - F.lit(1.0) / (tf.cast("double") + F.lit(1.0))


def constant_terms(
    spark: SparkSession, query: str, language: str = "french"
) -> dict[str, list[str]]:
    """Terms of one query text, each with the words that have it."""
    terms = spark.range(1).select(
        F.explode_outer(query_terms(F.lit(query), language)).alias("term")
    )
    rows = word_forms(terms, "term", "word", language).collect()
    found: dict[str, list[str]] = {}
    for row in rows:
        found.setdefault(row["term"], []).append(row["word"])
    return {term: sorted(found[term]) for term in sorted(found)}


def _occurrences(text: Column, forms: Sequence[str]) -> Column:
    """How often any of the words stands in a text; the text is not lexed."""
    pattern = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(forms)})(?![\p{{L}}\p{{N}}])"
    return F.regexp_count(F.lower(text), F.lit(pattern))


def may_match(text: Column, terms: Mapping[str, Sequence[str]]) -> Column:
    """Cheap necessary condition: the unchanged part of every term occurs."""
    condition = F.lit(bool(terms))
    for term in terms:
        condition = condition & F.contains(F.lower(text), F.lit(term[:-1]))
    return condition


def constant_match(text: Column, terms: Mapping[str, Sequence[str]]) -> Column:
    """``matches`` for the terms of ``constant_terms``."""
    condition = may_match(text, terms)
    for forms in terms.values():
        condition = condition & (_occurrences(text, forms) > 0)
    return condition


def constant_rank(text: Column, terms: Mapping[str, Sequence[str]]) -> Column:
    """``rank`` for the terms of ``constant_terms``; NULL without a match."""
    if not terms:
        return F.lit(None).cast("double")
    # No lambda: Spark then sees that two such plans are equal and runs one of them.
    shares = [F.nullif(saturation(_occurrences(text, forms)), F.lit(0.0)) for forms in terms.values()]
    return F.round(reduce(lambda a, b: a + b, shares) / F.lit(float(len(terms))), RANK_DECIMALS)


# ---------------------------------------------------------------- query modes

# The marks that decide the search mode of a query.
TEST_PREFIXES = ("test:", "debug:", "random:")
TEST_WORDS = ("performance", "benchmark")
QUESTION_WORDS = ("comment", "pourquoi", "quelle est")
MODES = ("text", "vector", "hybrid")


def _any(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def detect_mode(query: Column, requested: str = "auto") -> Column:
    """Search mode of a query: text, vector or hybrid."""
    if requested != "auto":
        return F.lit(requested)
    q = trim_all(F.lower(query))
    for_test = _any(
        [q.startswith(p) for p in TEST_PREFIXES] + [q.contains(w) for w in TEST_WORDS]
    )
    question = _any([q.contains(w) for w in QUESTION_WORDS])
    return (
        F.when(for_test | (word_count(q) <= 2), F.lit("text"))
        .when(question | (F.char_length(q) > 50), F.lit("hybrid"))
        .otherwise(F.lit("vector"))
    )


def mode_confidence(query: Column, mode: Column) -> Column:
    """Confidence in the detected mode; measured on the raw query."""
    n_words, n_chars = word_count(query), F.char_length(query)
    return (
        F.when((mode == "text") & (n_words <= 2), F.lit(0.8))
        .when((mode == "hybrid") & (query.contains("comment") | (n_chars > 50)), F.lit(0.9))
        .when((mode == "vector") & (n_chars > 20) & (n_words > 2), F.lit(0.7))
        .otherwise(F.lit(0.5))
    )


def _notes(query: Column, texts: Sequence[str]) -> Column:
    short, question, test, long = texts
    notes = F.array(
        F.when(word_count(query) <= 2, F.lit(short)),
        F.when(query.contains("comment") | query.contains("pourquoi"), F.lit(question)),
        F.when(query.startswith("test:") | query.startswith("debug:"), F.lit(test)),
        F.when(F.char_length(query) > 100, F.lit(long)),
    )
    return F.filter(notes, lambda note: note.isNotNull())


def mode_reasons(query: Column) -> Column:
    """Why a mode fits, as a list of short notes."""
    return _notes(query, ("short query", "complex question", "test query", "long query"))


def mode_suggestions(query: Column) -> Column:
    """What to try, as a list of short notes."""
    return _notes(
        query,
        ("use mode text", "use mode hybrid", "use a random probe vector", "use mode hybrid"),
    )


# ------------------------------------------------------------- joined columns


def concat_columns(columns: Sequence[Column]) -> Column:
    """Columns joined by a space; NULL counts as the empty text."""
    return F.concat_ws(" ", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def labelled(parts: Sequence[tuple[str, Column]], fallback: Column | None = None) -> Column:
    """Parts with their label joined by `` | ``, absent and empty ones left out."""
    shown = [F.when(c.cast("string") != "", F.concat(F.lit(label), c)) for label, c in parts]
    text = F.concat_ws(" | ", *shown)
    return text if fallback is None else F.coalesce(F.nullif(text, F.lit("")), fallback)
