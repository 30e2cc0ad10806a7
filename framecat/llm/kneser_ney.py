"""Quality from an interpolated modified Kneser-Ney model of trusted text.

The model is over characters: every code point of trusted text is a symbol, as is the
beginning of a text; n-grams of ORDER symbols. Code points that trusted text lacks share one
probability. Counts, continuation counts of the lower orders, context totals and the step from
each order to the next are Spark sums and joins of count tables that are sharded by n-gram. A
document's perplexity is kept if it is at most the given quantile of trusted documents of its
language.

The model lists the n-grams that trusted text has, and a share for each context; all others
follow from the shorter ones. It is sent to the tasks as sorted arrays, and a document's
perplexity is found where the document is. A join of documents' n-grams with the count shards
would shuffle each n-gram of the corpus; README has the figures.

``alphabet``, ``train`` and ``perplexities`` are the form of a bounded size: the LETTERS most
frequent code points and one symbol for all others, which share it as they do in trusted text. It
has SYMBOLS ** ORDER numbers (39 MB) whatever the corpus; ``classify`` takes it on request only.

Quantiles come from histograms of a thousandth of a logarithm, by language; a language
without trusted documents has the quantile of all. Trusted rows are all rows that the labels
call good, without a limit.

Defined results: a null or empty text has no perplexity and is not kept; a null language is a
language of its own; labels may repeat or be null; without trusted text nothing is kept,
as nothing is known; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framecat.llm.common import raw_hash, same, small_side, whole
from framecat.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS, ORDER = 54, 4
START, OTHER, SYMBOLS = 0, 1, LETTERS + 2
QUANTILE = 0.99
STEPS = 1000
PART_CHARS = 1 << 20
#: A code point is a number of so many bits, above zero; the beginning of a text is zero. A context has 63 bits.
BITS = 21
#: Code points of the first plane, and all that there are.
PLANE, POINTS = 1 << 16, 0x110000


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _totals(texts: DataFrame, size: int, keys: Callable[[np.ndarray, int], np.ndarray]) -> DataFrame:
    """key, n: sums over all texts of keys below ``size``, made in a dense array per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, chars = np.zeros(size, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for low in range(0, len(text), PART_CHARS):
                    # A part begins with the symbols that its first n-gram needs.
                    found = keys(_points(text[max(0, low - ORDER + 1) : low + PART_CHARS]), low)
                    held.append(found)
                    chars += len(found)
                    if chars > PART_CHARS:
                        counts += np.bincount(np.concatenate(held), minlength=size)
                        held, chars = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=size)
        seen = np.flatnonzero(counts)
        for low in range(0, len(seen), 1 << 16):
            part = seen[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], ["key", "n"])

    return texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def code_points(texts: DataFrame) -> DataFrame:
    """key, n: how often each code point occurs."""
    return materialise(_totals(texts, POINTS, lambda points, low: points[(ORDER - 1 if low else 0) :]), "code-points")


def alphabet(texts: DataFrame, counts: DataFrame | None = None) -> np.ndarray:
    """The symbol of each code point of the first plane; code points beyond it are OTHER."""
    counts = code_points(texts) if counts is None else counts
    top = counts.filter(F.col("key") < PLANE).orderBy(F.desc("n"), "key").limit(LETTERS).collect()
    symbols = np.full(PLANE, OTHER, np.uint8)
    symbols[[r.key for r in top]] = np.arange(len(top)) + 2
    return symbols


def rare_shares(counts: DataFrame, symbols: np.ndarray) -> np.ndarray:
    """Natural logarithms of the share of each code point within OTHER; zero for those that are symbols.

    Half a count is added to each that was seen and to all unseen ones together, which share one number.
    """
    found = counts.toArrow()  # a row a code point, POINTS at most
    keys, n = found.column(0).to_numpy(), found.column(1).to_numpy().astype(np.float64)
    letters = np.flatnonzero(symbols != OTHER)
    other = ~np.isin(keys, letters)
    keys, n = keys[other], n[other]
    base = n.sum() + 0.5 * (len(n) + 1)
    logs = np.full(POINTS, np.log(0.5 / base), np.float32)
    logs[keys], logs[letters] = np.log((n + 0.5) / base), 0.0
    return logs


def _grams(symbols: np.ndarray, points: np.ndarray, low: int) -> np.ndarray:
    """The n-gram that ends at each code point (of a part that starts at ``low``), as a number."""
    ids = np.where(points < PLANE, symbols[np.minimum(points, PLANE - 1)], OTHER).astype(np.int64)
    if not low:
        ids = np.concatenate((np.zeros(ORDER - 1, np.int64), ids))
    keys = ids[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        keys += ids[ORDER - 1 - back : len(ids) - back] * SYMBOLS**back
    return keys


def discounts(counts: DataFrame) -> list[float]:
    """What is taken from counts of one, two, and three or more."""
    n = list(counts.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first())
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    own = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return [min(max(d, 0.01), k - 0.01) for k, d in zip((1, 2, 3), own)]


def _discount(d: list[float]):
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def train(texts: DataFrame, symbols: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probability of the last symbol of every n-gram."""
    tables = [materialise(_totals(texts, SYMBOLS**ORDER, lambda points, low: _grams(symbols, points, low)), "grams")]
    for order in range(ORDER - 1, 0, -1):  # in how many different contexts the shorter n-gram continues one
        shorter = tables[0].groupBy((F.col("key") % SYMBOLS**order).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        tables.insert(0, materialise(shorter, "grams"))
    full, lower = np.full(SYMBOLS, 1 / (SYMBOLS - 1)), None
    full[START] = 0.0
    for order, counts in enumerate(tables, 1):
        d = discounts(counts)
        head = F.floor(F.col("key") / SYMBOLS).cast("long")
        contexts = counts.groupBy(head.alias("context")).agg(F.sum("n").alias("all"), F.sum(_discount(d)).alias("left"))
        contexts = contexts.withColumn("share", F.col("left") / F.col("all"))
        joined = counts.join(contexts, head == F.col("context"))
        joined = joined.withColumn("own", (F.col("n") - _discount(d)) / F.col("all"))
        if lower is None:
            told = joined.withColumn("p", F.col("own") + F.col("share") / (SYMBOLS - 1))
        else:
            tail = F.col("key") % SYMBOLS ** (order - 1)
            told = joined.join(lower, tail == F.col("_tail")).withColumn("p", F.col("own") + F.col("share") * F.col("below"))
        told = materialise(told.select("key", "p", "context", "share"), "probabilities")
        lower = told.select(F.col("key").alias("_tail"), F.col("p").alias("below"))
        shares = told.select("context", "share").distinct().toArrow()  # at most SYMBOLS ** (order - 1) rows
        listed = told.select("key", "p").toArrow()  # at most SYMBOLS ** order rows
        rest = np.ones(SYMBOLS ** (order - 1))
        rest[shares.column(0).to_numpy()] = shares.column(1).to_numpy()
        full = (rest.reshape(-1, 1) * (full.reshape(1, -1) if order == 1 else np.tile(full.reshape(-1, SYMBOLS), (SYMBOLS, 1)))).ravel()
        full[listed.column(0).to_numpy()] = listed.column(1).to_numpy()
    return np.log(np.maximum(full, 1e-30)).astype(np.float32)


def _perplexities(docs: DataFrame, totals: Callable[[list[str]], Iterable[float]], id: str, text: str, lang: str) -> DataFrame:
    """doc_id, raw, lang, n_symbols, perplexity for every row, given the logarithms of texts' probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).to_pylist()
            sizes = [len(text) for text in texts]
            sums = [float(np.exp(-total / size)) if size else None for total, size in zip(totals(texts), sizes)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], ["doc_id", "raw", "lang", "n_symbols", "perplexity"])

    rows = docs.select(F.col(id).alias("doc_id"), raw_hash(text).alias("raw"), F.col(lang).alias("lang"), whole(text).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:3])
    return rows.mapInArrow(run, f"{kinds}, n_symbols long, perplexity double")


def perplexities(docs: DataFrame, symbols: np.ndarray, logs: np.ndarray, rare: np.ndarray, id: str, text: str, lang: str) -> DataFrame:
    """doc_id, raw, lang, n_symbols, perplexity for every row."""
    sent = docs.sparkSession.sparkContext.broadcast((symbols, logs, rare))

    def totals(texts: list[str]) -> Iterator[float]:
        symbols, logs, rare = sent.value
        for text in texts:
            total = 0.0
            for low in range(0, len(text), PART_CHARS):
                points = _points(text[max(0, low - ORDER + 1) : low + PART_CHARS])
                total += float(logs[_grams(symbols, points, low)].sum(dtype=np.float64))
                total += float(rare[points[ORDER - 1 if low else 0 :]].sum(dtype=np.float64))
            yield total

    return _perplexities(docs, totals, id, text, lang)


def _parts(texts: list[str]) -> Iterator[list[tuple[int, str, int]]]:
    """Texts in parts, some at a time: the place of each part's text, the part behind the symbols that its first n-gram needs, and where it starts."""
    held, chars = [], 0
    for place, text in enumerate(texts):
        for low in range(0, len(text), PART_CHARS):
            held.append((place, text[max(0, low - ORDER + 1) : low + PART_CHARS], low))
            chars += len(held[-1][1])
            if chars >= PART_CHARS:
                yield held
                held, chars = [], 0
    if held:
        yield held


def _symbols(held: list[tuple[int, str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all parts one after the other, where n-grams end, and how many of them each part has."""
    missing = np.array([max(0, ORDER - 1 - low) for _, _, low in held])
    sizes = missing + np.array([len(part) for _, part, _ in held])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    ids = _points("".join("\0" * m + part for m, (_, part, _) in zip(missing.tolist(), held))).astype(np.int64) + 1
    ending = np.ones(len(ids), bool)
    for k in range(ORDER - 1):
        ids[starts[missing > k] + k] = START
        ending[starts + k] = False
    return ids, np.flatnonzero(ending), sizes - (ORDER - 1)


def _distinct(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and last symbols of the n-grams, each once; which of them each is; and how often each occurs."""
    seen = np.zeros(1 << BITS, bool)
    seen[ids] = True
    letters = np.flatnonzero(seen)
    bits = max(1, (len(letters) - 1).bit_length())
    if bits * ORDER < 64:  # by their numbers among the letters here, an n-gram is one number
        rank = np.zeros(1 << BITS, np.int32)
        rank[letters] = np.arange(len(letters))
        ids = rank[ids]
        keys = np.zeros(len(ends), np.int64)
        for back in range(ORDER - 1, -1, -1):
            keys = (keys << bits) | ids[ends - back]
        keys, place, n = np.unique(keys, return_inverse=True, return_counts=True)
        grams = [letters[(keys >> (bits * back)) & ((1 << bits) - 1)] for back in range(ORDER - 1, -1, -1)]
    else:
        grams = [ids[ends - back] for back in range(ORDER - 1, -1, -1)]
        place, n = np.arange(len(ends)), np.ones(len(ends), np.int64)
    contexts = np.zeros(len(n), np.int64)
    for symbols in grams[:-1]:
        contexts = (contexts << BITS) | symbols
    return contexts, grams[-1], place, n


def gram_counts(texts: DataFrame) -> DataFrame:
    """context, symbol, n: how often each n-gram occurs; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in _parts(batch.column(0).to_pylist()):
                contexts, symbols, _, n = _distinct(*_symbols(held)[:2])
                for low in range(0, len(n), 1 << 16):
                    rows = [pa.array(column[low : low + (1 << 16)], pa.int64()) for column in (contexts, symbols, n)]
                    yield pa.RecordBatch.from_arrays(rows, ["context", "symbol", "n"])

    counted = texts.mapInArrow(run, "context long, symbol long, n long")
    return materialise(counted.groupBy("context", "symbol").agg(F.sum("n").alias("n")), "grams")


#: The n-grams of one length: contexts in order, logarithms of their shares, n-grams (place of the context, symbol) in order, logarithms of their probabilities.
Listed = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def train_whole(texts: DataFrame) -> tuple[list[Listed], float]:
    """The n-grams of every length over all code points of the texts, and the logarithm of what each symbol has below them."""
    within = lambda order: (1 << BITS * (order - 1)) - 1
    tables = [gram_counts(texts)]
    for order in range(ORDER - 1, 0, -1):  # in how many different contexts the shorter n-gram continues one
        shorter = tables[0].groupBy(F.col("context").bitwiseAND(F.lit(within(order))).alias("context"), "symbol")
        tables.insert(0, materialise(shorter.agg(F.count(F.lit(1)).alias("n")), "grams"))
    base = 1 / (tables[0].count() + 1)  # one symbol more, for all code points that the texts lack
    levels, lower = [], None
    for order, counts in enumerate(tables, 1):
        d = discounts(counts)
        contexts = counts.groupBy(F.col("context").alias("_context")).agg(F.sum("n").alias("all"), F.sum(_discount(d)).alias("left"))
        joined = counts.join(contexts.withColumn("share", F.col("left") / F.col("all")), F.col("context") == F.col("_context"))
        joined = joined.withColumn("own", (F.col("n") - _discount(d)) / F.col("all"))
        if lower is None:
            told = joined.withColumn("below", F.lit(base))
        else:
            shorter = F.col("context").bitwiseAND(F.lit(within(order - 1))) == F.col("_shorter")
            told = joined.join(lower, shorter & (F.col("symbol") == F.col("_symbol")))
        p = F.col("own") + F.col("share") * F.col("below")
        told = materialise(told.select("context", "symbol", p.alias("p"), "share"), "probabilities")
        lower = told.select(F.col("context").alias("_shorter"), F.col("symbol").alias("_symbol"), F.col("p").alias("below"))
        levels.append(_listed(told))
    return levels, float(np.log(base))


def _listed(told: DataFrame) -> Listed:
    context, symbol, p, share = (c.to_numpy() for c in told.toArrow().columns)  # a row for each n-gram that trusted text has
    contexts, first, place = np.unique(context, return_index=True, return_inverse=True)
    keys = (place << BITS) | symbol
    order = np.argsort(keys)
    return contexts, np.log(share[first]).astype(np.float32), keys[order], np.log(p[order]).astype(np.float32)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def gram_logs(model: tuple[list[Listed], float], contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Natural logarithms of the symbols' probabilities after their contexts."""
    levels, base = model
    out, rest = np.zeros(len(symbols)), np.arange(len(symbols))
    for order in range(ORDER, 0, -1):
        held, shares, keys, logs = levels[order - 1]
        place, there = _find(held, contexts[rest] & ((1 << BITS * (order - 1)) - 1))
        entry, listed = _find(keys, (place << BITS) | symbols[rest])
        listed &= there
        out[rest[listed]] += logs[entry[listed]]
        out[rest[there & ~listed]] += shares[place[there & ~listed]]
        rest = rest[~listed]
    out[rest] += base
    return out


def whole_perplexities(docs: DataFrame, model: tuple[list[Listed], float], id: str, text: str, lang: str) -> DataFrame:
    """doc_id, raw, lang, n_symbols, perplexity for every row, by the model of ``train_whole``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def totals(texts: list[str]) -> np.ndarray:
        sums = np.zeros(len(texts))
        for held in _parts(texts):
            ids, ends, sizes = _symbols(held)
            contexts, symbols, place, _ = _distinct(ids, ends)
            of_parts = np.add.reduceat(gram_logs(sent.value, contexts, symbols)[place], np.concatenate(([0], np.cumsum(sizes)[:-1])))
            np.add.at(sums, [p for p, _, _ in held], of_parts)
        return sums

    return _perplexities(docs, totals, id, text, lang)


def _quantiles(trusted: DataFrame, quantile: float) -> DataFrame:
    """lang, limit: the upper edge of the histogram step that holds the quantile."""
    step = F.ceil(F.log("perplexity") * STEPS).alias("step")
    steps = trusted.groupBy("lang", step).agg(F.count(F.lit(1)).alias("n"))  # some thousand steps a language
    upto = W.partitionBy("lang").orderBy("step")
    steps = steps.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(W.partitionBy("lang")))
    found = steps.filter(F.col("upto") >= F.col("all") * quantile).groupBy("lang").agg(F.min("step").alias("step"))
    return found.select("lang", F.exp(F.col("step") / STEPS).alias("limit"))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = QUANTILE,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    good: str = "quality",
    bounded: bool = False,
) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, limit, kept for every row; ``bounded`` judges by the LETTERS most frequent code points."""
    ids = materialise(labels.filter(F.col(good) == 1).select(F.col(id).alias("_id")).distinct(), "trusted")
    texts = docs.select(F.col(id).alias("_doc"), whole(text).alias("text"))
    picked = texts.join(small_side(ids), F.col("_doc") == F.col("_id"), "left_semi").select("text")
    if bounded:
        points = code_points(picked)
        symbols = alphabet(picked, points)
        scored = perplexities(docs, symbols, train(picked, symbols), rare_shares(points, symbols), id, text, lang)
    else:
        scored = whole_perplexities(docs, train_whole(picked), id, text, lang)
    scored = materialise(scored, "perplexities")
    trusted = scored.filter("perplexity is not null").join(small_side(ids), F.col("doc_id") == F.col("_id"), "left_semi")
    per = materialise(_quantiles(trusted, quantile), "limits").withColumnRenamed("lang", "_lang")
    every = _quantiles(trusted.withColumn("lang", F.lit("")), quantile).select(F.col("limit").alias("_every"))
    told = scored.join(small_side(per), same(F.col("lang"), F.col("_lang")), "left").join(F.broadcast(every.agg(F.max("_every").alias("_every"))))
    limit = F.coalesce("limit", "_every")
    kept = F.coalesce(F.col("perplexity") <= limit, F.lit(False))
    return told.select("doc_id", "lang", "n_symbols", "perplexity", limit.alias("limit"), kept.alias("kept"))
