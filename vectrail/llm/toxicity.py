"""Toxicity by compression distance.

One zstandard dictionary is trained on windows of toxic texts and one on windows of ordinary
texts.  A window is a word.  Windows that ordinary texts hold as well say nothing about toxic
ones and are kept out of the toxic dictionary.  A window that is shorter under the toxic than under
the ordinary dictionary, by a threshold, counts for toxicity; the evidence of all windows of a
text is held against a second threshold.  Both thresholds are calibrated on labelled texts that
the dictionaries judging them have not seen.
"""

from __future__ import annotations

import random
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrail.llm.texts import pieces, release, third
from vectrail.session import work_path
from vectrail.sources.tables import write_table

LONGEST = 64  # bytes of a window; a longer word is cut into parts
CLOSE = b"\n" * 12  # zstandard writes the last bytes of its input as they are
STEPS = (2, 3, 4, 5, 6, 7)  # bytes saved, among which the threshold of a window is chosen
REMEMBERED = 200_000  # windows whose saving a task remembers
OPERATING_SCORE = 0.7  # the score of a text just at the calibrated threshold

_FORMAT = dict(
    window_log=19,
    chain_log=18,
    hash_log=17,
    search_log=5,
    min_match=4,
    target_length=32,
    strategy=zstandard.STRATEGY_BTLAZY2,
    write_content_size=False,
    write_dict_id=False,
)


def windows(text: bytes | None) -> Iterable[bytes]:
    """All words of the whole text, A-Z lower-cased; long ones in parts."""
    for piece in pieces(text or b""):
        words = piece.lower().split()
        if max(map(len, words), default=0) <= LONGEST:
            yield from words
        else:
            yield from (word[j : j + LONGEST] for word in words for j in range(0, len(word), LONGEST))


def train_dictionary(counts: list[tuple[bytes, int]], size: int, seed: int = 1) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes from windows and how often each counts.

    With too little to train on, the windows themselves: zstandard takes them as raw content.
    """
    samples = [b" " + w + b" " for w, n in sorted(counts) for _ in range(n)]
    random.Random(seed).shuffle(samples)
    total = sum(map(len, samples))
    try:
        if total < 20_000:
            raise zstandard.ZstdError("too few samples")
        return zstandard.train_dictionary(min(size, max(2000, total // 4)), samples, k=24, d=8, level=19).as_bytes()
    except zstandard.ZstdError:
        # The most frequent stand last, where zstandard reaches them with the fewest bits.
        raw = b"".join(b" " + w + b" " for w, _ in sorted(counts, key=lambda x: (x[1], x[0])))
        return raw[-size:] or b" "


class _Savings(dict):
    """Window to bytes saved; windows met before are remembered."""

    def __init__(self, ordinary, toxic):
        super().__init__()
        self.ordinary, self.toxic = ordinary, toxic

    def __missing__(self, window: bytes) -> int:
        # Twice, so that short words tell as well.
        whole = b" " + window + b"  " + window + b" " + CLOSE
        found = len(self.ordinary(whole)) - len(self.toxic(whole))
        if len(self) >= REMEMBERED:
            self.clear()
        self[window] = found
        return found

    def of(self, text: bytes | None) -> np.ndarray:
        """The savings on all windows of the whole text."""
        return np.fromiter(map(self.__getitem__, windows(text)), np.int64)


@dataclass
class Model:
    """Two dictionaries, the threshold of a window, and the line from evidence to score."""

    ordinary: bytes
    toxic: bytes
    step: int
    weights: np.ndarray

    def savings(self) -> _Savings:
        """The bytes that the toxic dictionary saves on a window."""
        form = zstandard.ZstdCompressionParameters(**_FORMAT)
        made = []
        for content in (self.ordinary, self.toxic):
            dictionary = zstandard.ZstdCompressionDict(content)
            dictionary.precompute_compress(compression_params=form)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=form).compress)
        return _Savings(*made)

    def score(self, evidence: np.ndarray, n_windows: np.ndarray) -> np.ndarray:
        """Scores from 0 to 1; 0 for texts without windows."""
        logit = evidence * self.weights[1] + self.weights[0]
        return np.where(n_windows > 0, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), 0.0)


def evidence_of(saved: np.ndarray) -> list[float]:
    """For each step, the bytes saved from the step on over all windows, against the length of the text."""
    if not len(saved):
        return [0.0] * len(STEPS)
    length = np.log(len(saved) + 3)
    return [float(np.maximum(saved - step + 1, 0).sum() / length) for step in STEPS]


def _window_counts(rows: DataFrame) -> DataFrame:
    """In how many labelled texts of each half and class every window stands."""

    def run(batches):
        for batch in batches:
            for text, toxic, half in zip(*(batch.column(c) for c in ("_text", "_toxic", "_half"))):
                found = pa.array(sorted(set(windows(text.as_py()))), pa.binary())
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [found, pa.array(np.full(n, toxic.as_py(), np.int32)), pa.array(np.full(n, half.as_py(), np.int32))],
                    ["window", "toxic", "half"],
                )
        release()

    # A text's windows, each once; the counts meet in Spark.
    cells = [
        F.count_if((F.col("toxic") == toxic) & (F.col("half") == half)).alias(f"n{toxic}{half}")
        for toxic in (0, 1)
        for half in (0, 1)
    ]
    rows = rows.select("_text", "_toxic", F.col("_half").cast("int").alias("_half"))
    return rows.mapInArrow(run, "window binary, toxic int, half int").groupBy("window").agg(*cells)


def _typical(counts: DataFrame, halves: list[int], texts: dict, most: int):
    """Windows of either class with their numbers of texts, from the halves given.

    Toxic ones are several times as frequent in toxic texts as in ordinary ones, beyond chance;
    ordinary ones are the most frequent.  At most ``most`` of each, the most telling first.
    """
    n = {t: sum((F.col(f"n{t}{h}") for h in halves), F.lit(0)) for t in (0, 1)}
    size = {t: max(1, sum(texts.get((t, h), 0) for h in halves)) for t in (0, 1)}
    rows = counts.select("window", n[0].alias("plain"), n[1].alias("toxic"))
    ratio = (F.col("toxic") / size[1]) / ((F.col("plain") + 0.5) / size[0])
    telling = F.col("toxic") * F.log(ratio)
    bad = rows.filter((F.col("toxic") >= 3) & (ratio >= 5) & (telling >= 12)).orderBy(F.desc(telling), "window")
    plain = rows.filter("plain >= 2").orderBy(F.desc("plain"), "window")
    return [
        [(bytes(r["window"]), min(r[c], 200)) for r in found.limit(most).select("window", c).collect()]
        for found, c in ((plain, "plain"), (bad, "toxic"))
    ]


def fit(
    documents: DataFrame,
    labels: DataFrame,
    windows_per_class: int = 20_000,
    labelled_texts: int = 60_000,
    dictionary_bytes: int = 60_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Model:
    """Learn from all windows of labelled documents that are not held out.

    At most ``labelled_texts`` of them, drawn by a hash of the id; their whole texts are looked at and
    their windows counted in Spark.  A hash of the id deals the documents into two halves.
    Dictionaries of one half judge texts of the other, and the thresholds are fitted to that; the final
    dictionaries come from both.  The driver gets at most ``windows_per_class`` windows of
    each class, the most telling, and six numbers of each text.
    NULL labels, ids and texts are not used; a document with several labels is toxic
    if one says so.  Without texts of both classes every score is 0.
    """
    spark = documents.sparkSession
    known = labels.filter(F.col(label_column).isNotNull()).groupBy(F.col(id_column).alias("_id")).agg(
        F.max(label_column).cast("int").alias("_toxic")
    )
    draw = F.xxhash64(F.lit("toxicity"), "_id")
    ids = known.filter(third("_id") != 1).withColumn("_draw", draw).withColumn("_half", F.pmod(F.col("_draw"), F.lit(2)))
    texts = documents.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("_text")).filter(
        F.col("_text").isNotNull()
    )
    # A bounded number of ids, so that no text is shuffled to meet its label.
    chosen = ids.orderBy("_draw", "_id").limit(labelled_texts).select("_id", "_toxic", "_half")
    chosen = write_table(chosen, work_path(spark, "toxicity-labelled"))
    rows = texts.join(F.broadcast(chosen), "_id")
    counts = write_table(_window_counts(rows), work_path(spark, "toxicity-windows"))
    sizes = {(r["_toxic"], r["_half"]): r["count"] for r in rows.groupBy("_toxic", "_half").count().collect()}

    def dictionaries(halves: list[int]) -> Model:
        plain, bad = _typical(counts, halves, sizes, windows_per_class)
        made = [train_dictionary(found, dictionary_bytes) for found in (plain, bad)]
        return Model(*made, STEPS[0], np.array([-30.0, 0.0]))

    halves = [dictionaries([0]), dictionaries([1])]
    seen = _evidence(rows, halves).collect()
    x = np.array([row["_x"] for row in seen], np.float64).reshape(len(seen), len(STEPS))
    y = np.array([row["_toxic"] for row in seen], np.float64)
    final = dictionaries([0, 1])
    return calibrate(final.ordinary, final.toxic, x, y)


def _evidence(rows: DataFrame, halves: list[Model]) -> DataFrame:
    """Evidence of texts by the dictionaries of the half that they are not in."""

    def run(batches):
        saving = [halves[1].savings(), halves[0].savings()]
        for batch in batches:
            found = [
                evidence_of(saving[half.as_py()].of(text.as_py()))
                for text, half in zip(batch.column("_text"), batch.column("_half"))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("_toxic"), pa.array(found, pa.list_(pa.float64()))], ["_toxic", "_x"])
        release()

    return rows.select("_text", "_toxic", F.col("_half").cast("int").alias("_half")).mapInArrow(run, "_toxic int, _x array<double>")


def _area(x: np.ndarray, y: np.ndarray) -> float:
    """How often a toxic text has more evidence than an ordinary one; ties count half."""
    _, place, times = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(times) - (times - 1) / 2)[place]
    bad = y.sum()
    return (rank[y == 1].sum() - bad * (bad + 1) / 2) / (bad * (len(y) - bad))


def calibrate(ordinary: bytes, toxic: bytes, x: np.ndarray, y: np.ndarray) -> Model:
    """The step with the largest area, and a line whose value at the best threshold is a score of 0.7.

    The best threshold on the evidence has the highest F1 on these rows; the slope is that of a
    logistic regression.
    """
    if not len(y) or y.min() == y.max():
        return Model(ordinary, toxic, STEPS[0], np.array([-30.0, 0.0]))
    areas = [_area(x[:, i], y) for i in range(len(STEPS))]
    best = int(np.argmax(areas))
    order = np.lexsort((y, x[:, best]))
    e, y = x[order, best], y[order]
    z = np.column_stack([np.ones(len(e)), e])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-6, 1e-3])
        step = np.linalg.solve(hessian, z.T @ (y - p) - np.array([0, 1e-3]) * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slope = max(w[1], 1e-6)
    cuts = np.unique(e)
    above = np.array([y[np.searchsorted(e, c) :].sum() for c in cuts])
    size = len(e) - np.searchsorted(e, cuts)
    f1 = 2 * above / (size + y.sum())
    at = int(np.argmax(f1))
    cut = (cuts[at] + (cuts[at - 1] if at else 0.0)) / 2
    return Model(ordinary, toxic, STEPS[best], np.array([np.log(OPERATING_SCORE / (1 - OPERATING_SCORE)) - slope * cut, slope]))


def score(
    documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``_id``, ``score``, ``n_windows`` and ``largest_saving`` of every whole text.

    Only the text is looked at.  NULL, empty and blank texts score 0.  Repeated rows
    score alike; an empty table gives no rows.
    """
    rows = documents.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    # Two dictionaries of bounded size and a few numbers.
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        saving, place = model.savings(), STEPS.index(model.step)
        for batch in batches:
            saved = [saving.of(text.as_py()) for text in batch.column("_text")]
            n = np.array([len(x) for x in saved], np.int64)
            evidence = np.array([evidence_of(x)[place] for x in saved])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(model.score(evidence, n)),
                    pa.array(n),
                    pa.array([float(x.max(initial=0)) for x in saved], pa.float64()),
                ],
                ["_id", "score", "n_windows", "largest_saving"],
            )
        del saving
        release()

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double, n_windows bigint, largest_saving double")
