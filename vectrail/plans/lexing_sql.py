"""The text functions in SQL, for the checks."""

from __future__ import annotations

import glob
import os
import zipfile
from functools import lru_cache

import pyspark

from vectrail.functions.text import SPACES, stem_patterns

# A class of the white-space characters for the regular expressions of the checks.
SPACE = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in SPACES) + "]"


@lru_cache(maxsize=None)
def stop_words(language: str) -> tuple[str, ...]:
    """The stop words Spark ships, read from its jar so that no session is needed."""
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    jar = glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar"))[0]
    with zipfile.ZipFile(jar) as archive:
        name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
        return tuple(archive.read(name).decode("utf-8").split())


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def words_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def stem_sql(word: str, language: str) -> str:
    for pattern, replacement in stem_patterns(language):
        word = f"regexp_replace({word}, '{pattern}', '\\1{replacement}')"
    return word


def lexemes_sql(text: str, language: str) -> str:
    stops = ", ".join(_quoted(w) for w in stop_words(language))
    kept = f"list_filter({words_sql(text)}, lambda w: w NOT IN ({stops}))"
    return f"list_transform({kept}, lambda w: {stem_sql('w', language)})"


def terms_sql(text: str, language: str) -> str:
    return f"list_distinct({lexemes_sql(text, language)})"


def ranked(words: str, language: str) -> str:
    """Documents that hold every term of ``words``, with their rank."""
    return f"""
        SELECT doc_id, lang,
               round(list_sum(list_transform(tf, lambda n: n / (n + 1.0))) / len(tf), 12) AS rank
        FROM (SELECT doc_id, lang,
                     list_transform(terms, lambda t: len(list_filter(lex, lambda w: w = t))) AS tf
              FROM (SELECT doc_id, lang, {lexemes_sql('text', language)} AS lex,
                           {terms_sql(_quoted(words), language)} AS terms
                    FROM documents))
        WHERE len(tf) > 0 AND list_min(tf) > 0
    """


def hashed_sql(source: str, dims: int) -> str:
    """Non-zero slots of the hashed vector of every text: key, slot, weight.

    ``source`` is a SELECT of ``key`` and ``t``.
    """
    return f"""
        SELECT key, slot, w / sqrt(sum(w * w) OVER (PARTITION BY key)) AS w
        FROM (SELECT key, ('0x' || substr(md5(word), 1, 8))::BIGINT % {dims} AS slot,
                     sum(CASE WHEN substr(md5(word), 9, 1) < '8' THEN 1.0 ELSE -1.0 END) AS w
              FROM (SELECT key, unnest({words_sql('t')}) AS word FROM ({source}))
              GROUP BY ALL)
        WHERE w <> 0
    """
