"""Language ID by character language models with interpolated Kneser-Ney smoothing.

Words of all labelled texts are counted per language, then their character n-grams.
All of them are kept: a model is sorted arrays of n-gram hashes, with entries only
for the languages that have an n-gram.  A text belongs to the
language with the lowest cross-entropy per character; it is rejected if that is
far higher than what labelled texts of that language and like length have.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrail.llm.texts import free_prefix, release, third
from vectrail.session import work_path
from vectrail.sources.tables import write_table

ORDER = 4
START, END = "\x02", "\x03"
UNKNOWN = "und"
ROWS = 400  # texts that are scored together, fewer with more than 4 languages
BLOCK = 200_000  # words of a text that are scored together, likewise
COUNTED = 2500  # texts whose words are counted together
CACHED = 150_000  # words whose scores a worker remembers, likewise
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Iterator[str]:
    """Lower-cased runs of letters."""
    for match in _WORD.finditer((text or "").lower()):
        word = match[0]
        if word.isalpha() or any(c.isalpha() for c in word):
            yield word


def _word_counts(texts: DataFrame) -> DataFrame:
    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, COUNTED):
                batch = whole.slice(start, COUNTED)
                counts: dict[str, Counter] = {}
                for lang, text in zip(batch.column("_lang"), batch.column("_text")):
                    counts.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
                yield from _tables(counts)
        release()

    return texts.mapInArrow(run, "_lang string, _gram string, _n bigint").groupBy("_lang", "_gram").agg(
        F.sum("_n").alias("_n")
    )


def _gram_counts(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            counts: dict[str, Counter] = {}
            for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                of = counts.setdefault(lang, Counter())
                padded = START * (ORDER - 1) + word + END
                for i in range(len(word) + 1):
                    of[padded[i : i + ORDER]] += n
            yield from _tables(counts)
        release()

    return words.mapInArrow(run, "_lang string, _gram string, _n bigint").groupBy("_lang", "_gram").agg(
        F.sum("_n").alias("_n")
    )


def _tables(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    """A batch of rows per language; the counts are used up."""
    while counts:
        lang, of = counts.popitem()
        columns = [pa.array([lang] * len(of), pa.string()), pa.array(of.keys(), pa.string()), pa.array(of.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["_lang", "_gram", "_n"])


def hash_grams(codes: np.ndarray) -> np.ndarray:
    """Hashes of n-grams, given as rows of code points; the length is part of the hash."""
    h = np.full(len(codes), codes.shape[1] + 1, np.uint64)
    for column in codes.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _codes(grams: list[str], size: int) -> np.ndarray:
    joined = "".join(grams).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32).reshape(len(grams), size)


@dataclass
class Table:
    """Sorted hashes with values for some languages; those of ``keys[i]`` are ``starts[i]`` to ``starts[i + 1]``.

    Where that takes hardly more room, ``dense`` has a column per language.
    """

    keys: np.ndarray
    starts: np.ndarray
    languages: np.ndarray
    values: np.ndarray
    dense: np.ndarray | None = None

    @classmethod
    def of(cls, hashes: np.ndarray, languages: np.ndarray, values: np.ndarray, n: int, missing: float) -> Table:
        order = np.lexsort((languages, hashes))
        hashes, languages, values = hashes[order], languages[order], values[order].astype(np.float32)
        keys, starts = np.unique(hashes, return_index=True)
        table = cls(keys, np.append(starts, len(hashes)), languages, values)
        if len(keys) * n <= 4 * len(hashes):
            table.dense = np.full((len(keys), n), missing, np.float32)
            table.dense[np.repeat(np.arange(len(keys)), np.diff(table.starts)), languages] = values
            table.starts = table.languages = table.values = None
        return table

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are there, and their places among the keys."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        row = np.flatnonzero(self.keys[at] == hashes)
        return row, at[row]

    def apply(self, change: np.ufunc, p: np.ndarray, hashes: np.ndarray) -> None:
        """Change rows of ``p`` (hash, language) by the values that there are."""
        if not len(self.keys):
            return
        row, at = self.find(hashes)
        if self.dense is not None:
            p[row] = change(p[row], self.dense[at])
            return
        first, times = self.starts[at], np.diff(self.starts)[at]
        entry = np.arange(times.sum()) + np.repeat(first - (np.cumsum(times) - times), times)
        cell = np.repeat(row, times), self.languages[entry]
        p[cell] = change(p[cell], self.values[entry])


@dataclass
class Model:
    """Models of all languages side by side: per order, values of n-grams and of their contexts."""

    languages: list[str]
    uniform: float = 1.0
    grams: list[Table] = field(default_factory=list)
    contexts: list[Table] = field(default_factory=list)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Natural log of the probability of each word (and its end) in each language."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        padded = "".join(START * (ORDER - 1) + w + END for w in words)
        codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
        # Position of every predicted character in the padded text.
        owner = np.repeat(np.arange(len(words)), lengths)
        at = np.arange(len(owner)) + (owner + 1) * (ORDER - 1)
        out = np.zeros((len(words), len(self.languages)))
        step = max(1024, (1 << 19) // max(4, len(self.languages)))
        for start in range(0, len(at), step):
            here = at[start : start + step]
            p = np.full((len(here), len(self.languages)), self.uniform)
            for size in range(1, ORDER + 1):
                window = codes[here[:, None] + np.arange(1 - size, 1)]
                self.contexts[size - 1].apply(np.multiply, p, hash_grams(window[:, :-1]))
                self.grams[size - 1].apply(np.add, p, hash_grams(window))
            np.add.at(out, owner[start : start + step], np.log(p))
        return out


def kneser_ney(counts: dict[str, dict[str, int]]) -> Model:
    """``build`` from the counts of the longest n-grams, per language."""
    languages = sorted(counts)
    grams = [gram for language in languages for gram in counts[language]]
    sizes = [len(counts[language]) for language in languages]
    n = np.array([n for language in languages for n in counts[language].values()], np.int64)
    return build(languages, np.repeat(np.arange(len(languages), dtype=np.int32), sizes), _codes(grams, ORDER), n)


def build(languages: list[str], language: np.ndarray, codes: np.ndarray, n: np.ndarray) -> Model:
    """Models from all longest n-grams: number of the language, code points and count of each.

    The highest order uses the counts, the lower ones in how many different n-grams
    a shorter one is the end; each order gives a discount to the one below, and the
    lowest to a uniform share for every character.
    """
    model = Model(languages, 1.0 / (len(np.unique(codes)) + 1))
    grams, contexts = [], []
    for size in range(ORDER, 0, -1):
        once, twice = (np.bincount(language[n == k], minlength=len(languages)) for k in (1, 2))
        share = np.where(once + twice > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
        discount = np.clip(share, 0.1, 0.95)
        first, group = _groups(hash_grams(codes[:, :-1]), language)
        total = np.zeros(len(first))
        np.add.at(total, group, n)
        kinds = np.bincount(group, minlength=len(first))
        value = np.maximum(n - discount[language], 0.0) / total[group]
        grams.append(Table.of(hash_grams(codes), language, value, len(languages), 0.0))
        weight = discount[language[first]] * kinds / total
        contexts.append(Table.of(hash_grams(codes[first, :-1]), language[first], weight, len(languages), 1.0))
        first, group = _groups(hash_grams(codes[:, 1:]), language)
        codes, language, n = codes[first, 1:], language[first], np.bincount(group, minlength=len(first))
    model.grams, model.contexts = grams[::-1], contexts[::-1]
    return model


def _groups(hashes: np.ndarray, language: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of every different pair, and the number of its pair for each place."""
    order = np.lexsort((language, hashes))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(hashes[order]) != 0) | (np.diff(language[order]) != 0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


def train(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> Model:
    """Count all texts that have a language and are not held out, and build the models.

    All n-grams are kept, so the model grows with the number of different ones.  NULL texts
    and languages are not learnt from; without any, the model has no language.
    """
    spark = documents.sparkSession
    rows = documents.filter(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull() & (third(id_column) != 1))
    texts = rows.select(F.col(lang_column).alias("_lang"), F.col(text_column).alias("_text"))
    grams = write_table(_gram_counts(_word_counts(texts)), work_path(spark, "langid-grams"))
    languages = sorted(r["_lang"] for r in grams.select("_lang").distinct().collect())
    place = {language: i for i, language in enumerate(languages)}
    table = grams.toArrow()
    number = np.fromiter((place[x] for x in table.column("_lang").to_pylist()), np.int32, table.num_rows)
    return build(languages, number, _codes(table.column("_gram").to_pylist(), ORDER), table.column("_n").to_numpy())


class Scorer:
    """Sums the scores of words; words seen before are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))
        self.sizes = np.zeros(0)
        languages = max(4, len(model.languages))
        self.rows, self.block, self.cached = (max(1, 4 * most // languages) for most in (ROWS, BLOCK, CACHED))

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities (text, language) and numbers of characters."""
        logs = np.zeros((len(texts), len(self.model.languages)))
        chars = np.zeros(len(texts))
        streams = [words_of(t) for t in texts]
        found = [list(islice(s, self.block)) for s in streams]
        while any(found):
            self._learn(found)
            for i, words in enumerate(found):
                if words:
                    at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                    logs[i] += self.scores[at].sum(0)
                    chars[i] += self.sizes[at].sum()
            found = [list(islice(s, self.block)) if len(f) == self.block else [] for s, f in zip(streams, found)]
        return logs, chars

    def _learn(self, found: list[list[str]]) -> None:
        if len(self.place) > self.cached:
            self.__init__(self.model)
        new = sorted({w for words in found for w in words if w not in self.place})
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
            self.sizes = np.concatenate([self.sizes, [len(w) + 1 for w in new]])


def score(documents: DataFrame, model: Model, text_column: str = "text", prefix: str = "_lang") -> DataFrame:
    """All rows and columns with ``<prefix>_pred``, ``_score``, ``_entropy`` and ``_chars``.

    ``_pred`` is the language with the lowest cross-entropy per character (ties: first by
    name), ``und`` where the text has no letter; ``_score`` weighs it against the others.
    Where columns begin with the prefix, it gets underscores appended (``texts.free_prefix``).
    """
    prefix = free_prefix(documents, prefix)
    place = documents.columns.index(text_column)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = [f"{prefix}_{n}" for n in ("pred", "score", "entropy", "chars")]

    def run(batches):
        scorer = Scorer(shared.value)
        try:
            yield from judge(batches, scorer)
        finally:
            scorer.__init__(shared.value)  # forgets its words
            release()

    def judge(batches, scorer):
        languages = np.array([*shared.value.languages, UNKNOWN], object)
        for whole in batches:
            for start in range(0, whole.num_rows, scorer.rows):
                batch = whole.slice(start, scorer.rows)
                logs, chars = scorer.texts(batch.column(place).to_pylist())
                known = (chars > 0) & (len(languages) > 1)
                if len(languages) > 1:
                    entropy = -logs / np.maximum(chars, 1)[:, None]
                    best = np.where(known, entropy.argmin(1), len(languages) - 1)
                    least = entropy.min(1)
                    # Evidence counts up to 20 characters, so that no score is sure of itself.
                    weight = np.minimum(chars, 20)[:, None]
                    sure = 1 / np.exp(-weight * (entropy - least[:, None])).sum(1)
                else:
                    best, least, sure = np.zeros(len(chars), int), np.zeros(len(chars)), np.zeros(len(chars))
                more = [
                    pa.array(languages[best], pa.string()),
                    pa.array(np.where(known, sure, 0.0)),
                    pa.array(least, mask=~known),
                    pa.array(chars.astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *names])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields]
    kinds += [f"{names[0]} string", f"{names[1]} double", f"{names[2]} double", f"{names[3]} bigint"]
    return documents.mapInArrow(run, ", ".join(kinds))


def _length_class(chars: Column) -> Column:
    return F.least(F.floor(F.log2(F.greatest(chars, F.lit(1)))), F.lit(12)).cast("int")


def limits_of(classes: list[tuple[str, int, int, float, float]], spreads: float, margin: float) -> list[tuple[str, int, float]]:
    """A limit per language and length class, from (language, class, texts, median, upper quartile) of each.

    The quartile's way from the median, or a twentieth of the median, is the spread.  A class with
    fewer than 100 texts takes the limit of the nearest class of its language (ties: the shorter one); a language
    without any takes, per class, the median of the others'.
    """
    own: dict[str, dict[int, float]] = {}
    for language, of, n, median, quartile in classes:
        if n >= 100:
            spread = max((quartile - median) / 0.6745, median / 20)  # 0.6745: of a normal distribution
            own.setdefault(language, {})[of] = (median + spreads * spread) * margin
    if not own:
        return []
    whole = {
        language: [of[min(of, key=lambda y: (abs(x - y), y))] for x in range(13)] for language, of in own.items()
    }
    others = np.median(list(whole.values()), axis=0).tolist()
    names = {c[0] for c in classes}
    return [(name, x, whole.get(name, others)[x]) for name in sorted(names) for x in range(13)]


def identify(
    documents: DataFrame,
    spreads: float = 8.0,
    margin: float = 1.1,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    prefix: str = "_lang",
) -> DataFrame:
    """Learn from ``documents`` and add to all its rows what ``score`` says and ``<prefix>_rejected``.

    A text is rejected if it has no letter, or if its cross-entropy is more than ``margin``
    times the median of the learnt texts of its predicted language and length class (powers of two)
    plus ``spreads`` times their spread; see ``limits_of``.  Up to a quarter of noise among the
    learnt texts of a class does not move that far.

    NULL and empty texts are ``und`` and rejected.  Rows whose ``lang`` is NULL are only
    scored.  Repeated rows are judged alike; an empty table gives no rows.  Where columns
    begin with the prefix, it gets underscores appended (``texts.free_prefix``).
    """
    prefix = free_prefix(documents, prefix)
    model = train(documents, id_column, text_column, lang_column)
    # Scored twice, for the limits and for the result: cheaper than to keep a copy of the texts.
    scored = score(documents, model, text_column, prefix)
    pred, entropy = F.col(f"{prefix}_pred"), F.col(f"{prefix}_entropy")
    length = _length_class(F.col(f"{prefix}_chars"))
    learnt = F.col(lang_column).isNotNull() & (third(id_column) != 1) & entropy.isNotNull()
    classes = scored.filter(learnt).groupBy(pred.alias("_of"), length.alias("_class")).agg(
        F.count("*").alias("_n"), F.percentile_approx(entropy, [0.5, 0.75], 10_000).alias("_q")
    )
    found = [(r["_of"], r["_class"], r["_n"], *r["_q"]) for r in classes.collect()]  # 13 rows a language at most
    names = [f"{prefix}_{n}" for n in ("of", "class", "limit")]
    limits = documents.sparkSession.createDataFrame(
        limits_of(found, spreads, margin), f"`{names[0]}` string, `{names[1]}` int, `{names[2]}` double"
    )
    same = (pred == F.col(names[0])) & (length == F.col(names[1]))
    judged = scored.join(F.broadcast(limits), same, "left")
    rejected = (pred == UNKNOWN) | (entropy > F.coalesce(F.col(names[2]), F.lit(float("inf"))))
    return judged.withColumn(f"{prefix}_rejected", F.coalesce(rejected, F.lit(True))).drop(*names)
