"""Toxicity by cumulative-link ordinal regression over sparse words.

P(grade > k) = sigmoid(w . x - t_k): one weight for each word, shared by all ordered
thresholds. Features are all words and beginnings of words whose document counts differ between
toxic and other labelled rows by LEAST_ERRORS standard errors of the log odds; the value of
one is SCALE times the root of its share of the text's words, so what counts is how dense it is.
The output is the expected grade.

Labels tell toxic or not. The grade of a toxic row is 1, 2 or 3 by the density of strong words,
their occurrences per word of the text: by which of the toxic rows' thirds it is in. Which
words are strong is told by the other half of the labelled rows (halves by a hash of the id),
so a row's grade does not come from words picked for being in it. All other rows have grade 0.

The fit uses at most SAMPLE_ROWS labelled rows, picked by a hash of the id; their words are
counted in Spark, and what comes to the driver is the features that pass the test on those
rows and their values. Scoring runs over all rows, with a table of these features.

Defined results: null and empty texts have no features and get the grade that the thresholds
give; a word counts without punctuation at its ends, in lower case of A-Z; labels that are
null are left out, a row with several labels counts with each; without labelled rows of both
kinds every severity is 0; toxic rows of one density have one grade.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.llm.common import raw_hash, sent, small_side, whole
from framecat.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 20_000
LEAST_ROWS, LEAST_ERRORS, STRONG_ERRORS, STRONG_ODDS = 5, 3.0, 4.0, 3.0
GRADES, SCALE = 4, 10.0
STEPS, RATE, RIDGE = 400, 0.05, 1e-4
#: Rows whose features are worked on at once in a step of the fit.
FIT_ROWS = 1 << 10
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
EDGES = b".,;:!?\"'()[]{}<>|*_-#$%&"
BEGINNINGS = (3, 4, 5)


def traits(text: str) -> tuple[Counter[str], int]:
    """How often each word and each beginning of longer words, which stands for their family, is in a text; and its words."""
    words: Counter[bytes] = Counter()
    for word, n in Counter(text.encode().translate(LOWER).split()).items():
        words[word.strip(EDGES)] += n
    found: Counter[str] = Counter()
    for word, n in words.items():
        if word:
            told = word.decode("utf-8", "replace")
            found[told] += n
            for length in BEGINNINGS:
                if len(told) > length:
                    found[told[:length] + "*"] += n
    return found, words.total()


def value(n: np.ndarray | float, words: np.ndarray | int) -> np.ndarray | float:
    """What a feature with n occurrences weighs in a text of so many words."""
    return SCALE * np.sqrt(n / words)


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, rows: list[list[int]], values: list[list[float]] | None = None) -> np.ndarray:
        """P(grade > k) for each row and threshold, with the values of its features (1 if not given)."""
        lines = np.array([self.weights[r].sum() if values is None else self.weights[r] @ values[k] for k, r in enumerate(rows)])
        return _sigmoid(lines[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[list[int]], grades: np.ndarray, size: int, values: list[list[float]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """fit_flat for rows as lists of features, with their values (1 if not given)."""
    column = np.array([c for r in rows for c in r], np.int64)
    amount = np.ones(len(column)) if values is None else np.array([v for r in values for v in r], np.float64)
    return fit_flat(np.array([len(r) for r in rows], np.int64), column, amount, grades, size)


def fit_flat(lengths: np.ndarray, column: np.ndarray, amount: np.ndarray, grades: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised negative log likelihood, by Adam over all rows.

    Rows come as the numbers of their features, and all their features and values one after the other.
    """
    count = len(lengths)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    blocks = [(int(low), int(min(count, low + FIT_ROWS))) for low in range(0, count, FIT_ROWS)]
    reached = np.array([(grades > k).mean() for k in range(GRADES - 1)]).clip(1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(-np.log(reached / (1 - reached)) + np.arange(GRADES - 1) * 1e-2)
    # The first threshold, and logarithms of the steps to the next ones, keep the order.
    state = np.concatenate((np.zeros(size), start[:1], np.log(np.diff(start))))
    mean, square = np.zeros_like(state), np.zeros_like(state)
    at = np.arange(count)
    for step in range(1, STEPS + 1):
        weights, steps = state[:size], np.exp(state[size + 1 :])
        thresholds = state[size] + np.concatenate(([0.0], np.cumsum(steps)))
        line = np.empty(count)
        for low, high in blocks:
            part, owner = slice(starts[low], starts[high]), np.repeat(np.arange(high - low), lengths[low:high])
            line[low:high] = np.bincount(owner, weights[column[part]] * amount[part], minlength=high - low)
        above = np.column_stack((np.ones(count), _sigmoid(line[:, None] - thresholds), np.zeros(count)))
        slope = above * (1 - above)
        high, low = above[at, grades], above[at, grades + 1]
        part = 1 / np.maximum(high - low, 1e-9) / count
        by_line = -(slope[at, grades] - slope[at, grades + 1]) * part
        by_threshold = np.zeros((count, GRADES + 1))
        by_threshold[at, grades] += slope[at, grades] * part
        by_threshold[at, grades + 1] -= slope[at, grades + 1] * part
        by_threshold = by_threshold[:, 1:-1].sum(axis=0)
        later = np.cumsum(by_threshold[::-1])[::-1]
        by_weight = RIDGE * weights
        for low, high in blocks:
            part = slice(starts[low], starts[high])
            by_weight += np.bincount(column[part], np.repeat(by_line[low:high], lengths[low:high]) * amount[part], minlength=size)
        slope_of = np.concatenate((by_weight, later[:1], later[1:] * steps))
        mean = 0.9 * mean + 0.1 * slope_of
        square = 0.999 * square + 0.001 * slope_of**2
        state -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return state[:size], state[size] + np.concatenate(([0.0], np.cumsum(np.exp(state[size + 1 :]))))


def _words_of(rows: DataFrame) -> DataFrame:
    """toxic, half, the number of words, and how often each trait is in them, of labelled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                told = [traits(t) for t in part.column(2).to_pylist()]
                held = pa.array([sorted(found.items()) for found, _ in told], pa.map_(pa.string(), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([n for _, n in told], pa.int64()), held], ["toxic", "half", "size", "words"])

    return rows.select("toxic", "half", "text").mapInArrow(run, "toxic int, half int, size long, words map<string, long>")


def _tested(words: DataFrame, totals: dict[int, tuple[int, int]]) -> DataFrame:
    """word, errors (standard errors of its log odds), and strong_0, strong_1: whether it is strong in that half."""
    sums = []
    for half in (0, 1):
        here = F.col("half") == half
        sums += [F.sum(F.when(here, F.col("toxic")).otherwise(0)).alias(f"a{half}"), F.count_if(here).alias(f"n{half}")]
    seen = words.groupBy("word").agg(*sums).filter(F.col("n0") + F.col("n1") >= LEAST_ROWS)

    def test(a: Column, n: Column, toxic: int, rows: int) -> tuple[Column, Column]:
        b = n - a
        odds = F.log((a + 0.5) / (F.lit(toxic) - a + 0.5)) - F.log((b + 0.5) / (F.lit(rows - toxic) - b + 0.5))
        return odds, odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))

    every = [sum(x) for x in zip(*totals.values())]
    told = [test(F.col("a0") + F.col("a1"), F.col("n0") + F.col("n1"), *every)[1].alias("errors")]
    for half in (0, 1):
        odds, errors = test(F.col(f"a{half}"), F.col(f"n{half}"), *totals.get(half, (0, 0)))
        whole_word = ~F.col("word").endswith("*")
        told.append((whole_word & (errors >= STRONG_ERRORS) & (odds >= STRONG_ODDS)).alias(f"strong_{half}"))
    return seen.select("word", *told).filter((F.abs("errors") >= LEAST_ERRORS) | F.col("strong_0") | F.col("strong_1"))


def graded(toxic: np.ndarray, density: np.ndarray) -> np.ndarray:
    """0 for rows that are not toxic; else 1 to GRADES - 1 by the parts of equal size of the toxic rows' densities."""
    cuts = np.quantile(density[toxic], np.arange(1, GRADES - 1) / (GRADES - 1)) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(cuts, density, side="left"), 0)


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model | None:
    told = labels.select(F.col(id).alias("_id"), F.col(toxic).cast("int").alias("toxic")).filter("_id is not null and toxic is not null")
    told = materialise(told, "labels")
    every = max(1, -(-told.count() // SAMPLE_ROWS))
    told = told.filter(F.pmod(F.xxhash64("_id"), F.lit(every)) == 0).withColumn("half", F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(2)).cast("int"))
    texts = docs.select(F.col(id).alias("_doc"), whole(text).alias("text")).join(small_side(told), F.col("_doc") == F.col("_id"))
    sample = materialise(_words_of(texts).withColumn("row", F.monotonically_increasing_id()), "labelled")
    totals = {r.half: (r.a, r.n) for r in sample.groupBy("half").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n")).collect()}
    toxic_rows, rows = (sum(x) for x in zip(*totals.values())) if totals else (0, 0)
    if not 0 < toxic_rows < rows:
        return None
    words = sample.select("row", "toxic", "half", F.explode("words").alias("word", "n"))
    tested = materialise(_tested(words, totals), "tested")
    # Features are words of the bounded sample that passed the test; so are their values.
    top = tested.filter(F.abs("errors") >= LEAST_ERRORS).orderBy(F.desc(F.abs("errors")), "word").select("word").collect()
    place = {r.word: k for k, r in enumerate(top)}
    numbers = docs.sparkSession.createDataFrame(pa.table({"word": pa.array(place, pa.string()), "place": pa.array(place.values(), pa.int32())}))
    strong = F.when(F.col("half") == 0, F.col("strong_1")).otherwise(F.col("strong_0"))
    feature = F.when(F.col("place").isNotNull(), F.struct("place", F.col("n").cast("int").alias("n")))
    found = words.join(small_side(tested.join(small_side(numbers), "word", "left")), "word").groupBy("row").agg(
        F.array_sort(F.collect_list(feature)).alias("held"), F.sum(F.when(strong, F.col("n")).otherwise(0)).alias("strong")
    )
    none = F.array().cast("array<struct<place: int, n: int>>")
    held = sample.select("row", "toxic", "size").join(found, "row", "left")
    held = held.select("toxic", "size", F.coalesce("strong", F.lit(0)).alias("strong"), F.coalesce("held", none).alias("held"))
    # At most about SAMPLE_ROWS rows of two numbers a feature, as flat arrays.
    held = held.orderBy("toxic", "size", "held").toArrow().combine_chunks()
    toxic_, size, strong_ = (held.column(k).to_numpy() for k in range(3))
    lists = held.column(3).combine_chunks()
    counts, told = np.diff(lists.offsets.to_numpy()), lists.flatten()
    values = value(told.field("n").to_numpy(), np.repeat(np.maximum(size, 1), counts))
    grades = graded(toxic_ > 0, strong_ / np.maximum(size, 1))
    weights, thresholds = fit_flat(counts, told.field("place").to_numpy(), values, grades, max(1, len(top)))
    return Model(place, weights, thresholds)


def severities(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, raw, severity (expected grade), grade (the most probable), toxic for every row."""
    held = sent(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = cloudpickle.loads(held.value)
        for batch in batches:
            above = np.zeros((len(batch), GRADES - 1))
            for low in range(0, len(batch) if model else 0, 256):
                lists, values = [], []
                for text in batch.slice(low, 256).column(2).to_pylist():
                    found, size = traits(text)
                    here = [(model.features[w], n) for w, n in found.items() if w in model.features]
                    lists.append([k for k, _ in here])
                    values.append([value(n, size) for _, n in here])
                above[low : low + 256] = model.above(lists, values)
            shares = -np.diff(np.column_stack((np.ones(len(batch)), above, np.zeros(len(batch)))), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(above.sum(axis=1)), pa.array(shares.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= 0.5)],
                ["doc_id", "raw", "severity", "grade", "toxic"],
            )

    rows = docs.select(F.col(id).alias("doc_id"), raw_hash(text).alias("raw"), whole(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, raw long, severity double, grade int, toxic boolean")
