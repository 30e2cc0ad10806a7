"""Language-model scores from a probabilistic suffix tree over words.

Symbols are all training words, an end, a start (in contexts only) and one symbol for words that
training lacks. The root state has the additive unigram distribution over all training tokens,
so the root alone scores a text exactly as the unigram model does.

A context of one or two symbols becomes a state if its next-symbol distribution diverges from
that of its suffix: the mean log ratio of both over its occurrences, each left out of the
counts in turn, must reach MIN_DIVERGENCE. Distributions are smoothed with the suffix state's
by as many virtual counts as the context has different next symbols. A state lists the next
symbols that occur more than once and gain, all others share what is left as in its suffix state, so every
distribution sums to one. A token is scored by the longest suffix of its past that is a state.

All counts (words, pairs, triples of contexts that occur MIN_COUNT times) are Spark sums over every
training row, and no words, states or listed probabilities are left out, however many there are. They are
sorted tables of the shared folder, written by tasks in files of about SHARD_ROWS rows; tasks
map the files, so neither the driver nor a task's own memory holds them. The FREQUENT most
frequent words have the smallest numbers and travel to the tasks, which look there first.

A word is known by 64 bits of a hash of its bytes, with which a task finds and numbers words
without a Python object each.

Defined results: a null text is empty and has one token, the end; a null id counts as the
empty text when rows are dealt to training; repeated rows are scored as separate rows; in a
table without training rows every token has probability one half over one half, so scores
are zero.
"""

from __future__ import annotations

import math
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.llm.common import sent, small_side, whole
from framecat.llm.warc import store_of
from framecat.session import materialise, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FREQUENT = 1 << 16
MIN_COUNT = 32
MIN_DIVERGENCE = 0.02
END, OTHER, START, FIRST_WORD = 0, 1, 2, 3
#: A symbol has so many bits; two of them, or the place of a state and one, are a number.
BITS = 31
MASK = (1 << BITS) - 1
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
HELD_PER_TASK = 500_000
#: So many characters of texts are worked on at once, and so many rows go into a file of a table.
CHUNK, SHARD_ROWS = 1 << 20, 1 << 20

# Fixed values of the hash of words: a random number for each byte, and an odd one whose powers tell places apart.
_OF_BYTE = np.random.default_rng(9).integers(0, 1 << 64, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def held_out(id: str) -> Column:
    """Whether a row is kept out of training: one row in five."""
    return F.pmod(F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


class Words:
    """Finds and hashes the words of texts, all at once."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size > len(self.up):
            size = max(size, 2 * len(self.up))
            self.up, self.down = (
                np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, x, np.uint64), dtype=np.uint64)))
                for x in (_STEP, pow(_STEP, -1, 1 << 64))
            )

    def hashes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words one after the other, and how many of them come before each text and behind the last."""
        raw = [text.encode() for text in texts]
        data = np.frombuffer(b" ".join(raw).translate(LOWER), np.uint8)
        edges = np.diff(np.concatenate(([False], ~_WHITE[data], [False])).astype(np.int8))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self._grow(len(data))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(_OF_BYTE[data] * self.up[: len(data)], dtype=np.uint64)))
        h = (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(times)
        offsets = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)))
        return h.view(np.int64), np.searchsorted(starts, offsets)


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    low = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size > CHUNK:
            yield texts[low : at + 1]
            low, size = at + 1, 0
    if low < len(texts):
        yield texts[low:]


def count_keys(rows: DataFrame, keys_of: Callable, known=None) -> DataFrame:
    """key, n of the numbers that keys_of gives for some texts and what is known; sorted and summed per task in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_, held, size = cloudpickle.loads(known.value) if known else Words(), [], 0

        def out() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([*held, np.empty(0, np.int64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])

        for batch in batches:
            for texts in _chunks(batch.column(0).to_pylist()):
                held.append(keys_of(texts, with_))
                size += len(held[-1])
                if size > 4 * HELD_PER_TASK:
                    yield out()
                    held, size = [], 0
        yield out()

    return rows.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def count_words(rows: DataFrame) -> DataFrame:
    """key, n of the hashes of all words."""
    return count_keys(rows, lambda texts, words: words.hashes(texts)[0])


@dataclass
class Table:
    """Columns of numbers in order of a key that occurs once, in files of the shared folder: (first key, rows, name)."""

    path: str
    columns: tuple[str, ...]
    kinds: tuple[str, ...]
    files: list[tuple[int, int, str]]
    maps: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "maps": {}}

    def _held(self, column: str) -> list[np.ndarray]:
        if column not in self.maps:
            kind = self.kinds[self.columns.index(column)]
            self.maps[column] = [_mapped(f"{self.path}/{name}.{column}", kind) for _, _, name in self.files]
            self.maps["first"] = np.array([first for first, _, _ in self.files], np.int64)
            self.maps["start"] = np.cumsum([0, *[n for _, n, _ in self.files]])
        return self.maps[column]

    def __len__(self) -> int:
        return sum(n for _, n, _ in self.files)

    def whole(self, column: str) -> np.ndarray:
        """All of a column: for small tables."""
        return np.concatenate([*self._held(column), np.empty(0, self.kinds[self.columns.index(column)])])

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of keys, and whether they are there."""
        held = self._held("key")
        if len(held) < 2:
            return _find(held[0] if held else np.empty(0, np.int64), wanted)
        place, there = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        for k, at in self._dealt(wanted, self.maps["first"][1:], "left"):
            inside, there[at] = _find(held[k], wanted[at])
            place[at] = inside + self.maps["start"][k]
        return place, there

    def take(self, column: str, places: np.ndarray) -> np.ndarray:
        held = self._held(column)
        if len(held) < 2:
            return held[0][places] if held else np.empty(0, self.kinds[self.columns.index(column)])
        out = np.empty(len(places), self.kinds[self.columns.index(column)])
        for k, at in self._dealt(places, self.maps["start"][1:-1], "left"):
            out[at] = held[k][places[at] - self.maps["start"][k]]
        return out

    @staticmethod
    def _dealt(numbers: np.ndarray, edges: np.ndarray, side: str) -> Iterator[tuple[int, np.ndarray]]:
        """For each file the numbers that belong to it."""
        order = np.argsort(numbers, kind="stable")
        cuts = [0, *np.searchsorted(numbers[order], edges, side).tolist(), len(order)]
        return ((k, order[low:high]) for k, (low, high) in enumerate(zip(cuts, cuts[1:])) if low < high)


def _mapped(uri: str, kind: str) -> np.ndarray:
    store, path = store_of(uri)
    if not isinstance(store, fs.LocalFileSystem):
        with tempfile.NamedTemporaryFile() as copy:  # mapped before its name goes
            fs.copy_files(path, copy.name, source_filesystem=store)
            return np.memmap(copy.name, kind, "r")
    return np.memmap(path, kind, "r")


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def stored(rows: DataFrame, total: int, label: str) -> Table:
    """Rows (key, a long that occurs once; numbers) as a table. A file's rows are held by the task that writes it.

    Each file has a name of its own, and those that the table names count, so a task may run twice.
    """
    path, columns = scratch_path(rows.sparkSession, label), tuple(rows.columns)
    kinds = tuple("float64" if kind == "double" else "int64" for _, kind in rows.dtypes)
    store, folder = store_of(path)
    store.create_dir(folder, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(map(len, held)):
            return
        table, name = pa.Table.from_batches(held), uuid.uuid4().hex
        for column, kind in zip(columns, kinds):
            store, at = store_of(f"{path}/{name}.{column}")
            with store.open_output_stream(at) as out:
                out.write(np.ascontiguousarray(table.column(column).to_numpy(), kind))
        yield pa.RecordBatch.from_arrays([pa.array([table.column("key")[0].as_py()]), pa.array([len(table)]), pa.array([name])], ["first", "n", "name"])

    placed = rows.repartitionByRange(max(1, math.ceil(total / SHARD_ROWS)), "key").sortWithinPartitions("key")
    told = placed.mapInArrow(write, "first long, n long, name string").collect()  # a row a file
    return Table(path, columns, kinds, sorted(map(tuple, told)))


@dataclass
class Level:
    """The states of one context length, and listed probabilities by (place of the state, symbol)."""

    held: Table | None = None
    entries: Table | None = None

    @property
    def states(self) -> np.ndarray:
        return self.held.whole("key") if self.held else np.empty(0, np.int64)

    def score(self, contexts: np.ndarray, symbols: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """Natural logarithms of the next symbols' probabilities, given those of the suffix states."""
        if not self.held:
            return suffix
        place, there = self.held.find(contexts)
        out, at = suffix.copy(), np.flatnonzero(there)
        out[at] += self.held.take("rest", place[at])
        entry, listed = self.entries.find((place[at] << BITS) | symbols[at])
        out[at[listed]] = self.entries.take("log", entry[listed])
        return out


@dataclass
class Tree:
    """``frequent`` holds the hashes of the most frequent words in order, ``numbers`` their symbols and ``amounts`` counts by symbol."""

    frequent: np.ndarray
    numbers: np.ndarray
    amounts: np.ndarray
    rest: Table
    ends: int
    total: int
    kinds: int
    words: Words = field(default_factory=Words)
    one: Level = field(default_factory=Level)
    two: Level = field(default_factory=Level)

    @property
    def root(self) -> np.ndarray:
        """Logarithms for every symbol: for small trees."""
        return self.root_logs(np.arange(FIRST_WORD + len(self.frequent) + len(self.rest)))

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts one after the other, and where each text ends."""
        hashes, before = self.words.hashes(texts)
        told, place = np.unique(hashes, return_inverse=True)
        known = np.full(len(told), OTHER, np.int64)
        at, there = _find(self.frequent, told)
        known[there] = self.numbers[at[there]]
        left = np.flatnonzero(~there)
        at, there = self.rest.find(told[left])
        known[left[there]] = FIRST_WORD + len(self.frequent) + at[there]
        ids = np.full(len(hashes) + len(texts), END, np.int64)
        ids[np.arange(len(hashes)) + np.repeat(np.arange(len(texts)), np.diff(before))] = known[place]
        return ids, before[1:] + np.arange(1, len(texts) + 1)

    @staticmethod
    def past(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before each, and the contexts of two before each; -1 where a text has no second one."""
        before = np.concatenate(([START], ids[:-1]))
        before[ends[:-1]] = START
        second = np.concatenate(([-1], before[:-1]))
        return before, np.where(before == START, -1, (second << BITS) | before)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """How often training has each symbol."""
        first = FIRST_WORD + len(self.frequent)
        out = np.where(ids == END, self.ends, 0)
        at = np.flatnonzero((ids >= FIRST_WORD) & (ids < first))
        out[at] = self.amounts[ids[at] - FIRST_WORD]
        at = np.flatnonzero(ids >= first)
        out[at] = self.rest.take("n", ids[at] - first)
        return out

    def root_logs(self, ids: np.ndarray) -> np.ndarray:
        return np.log((self.counts(ids) + 0.5) / (self.total + 0.5 * (self.kinds + 1)))

    def suffix_logs(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        pairs, place = np.unique((before << BITS) | ids, return_inverse=True)
        return self.one.score(pairs >> BITS, pairs & MASK, self.root_logs(pairs & MASK))[place]

    def logs(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        before, two = self.past(ids, ends)
        return self.two.score(two, ids, self.suffix_logs(before, ids))


def _at_most(rows: DataFrame, column: str, most: int) -> DataFrame:
    """The rows with the largest values, at most so many: the limit comes from histograms of the values.

    Where not even the first step fits, it is split into finer steps, and one of those by a hash of the keys.
    """
    value, names = F.log2(column), [n for n, kind in rows.dtypes if kind != "double"]
    inside = F.lit(True)
    for step in (F.floor(value * 16), F.floor(value * 4096), F.pmod(F.xxhash64(*names), F.lit(4096))):
        found = rows.filter(inside).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()  # a few hundred rows, of hashes 4,096
        limit = split = None
        for row in sorted(found, reverse=True):
            if row.n > most:
                split = row.step
                break
            limit, most = row.step, most - row.n
        if limit is not None:
            return rows.filter(inside & (step >= limit))
        if split is None:
            break
        inside = inside & (step == split)
    return rows.limit(0)


def _told(found: DataFrame, known) -> DataFrame:
    """context, symbol, n, below of counted keys, written: below is the suffix state's probability.

    ``known`` is a tree without the states to come, and a table of contexts if keys hold their places. What occurs
    once is folded to the number of such symbols of a context, as symbol -1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, contexts = cloudpickle.loads(known.value)
        held, size = [], 0

        def out() -> pa.RecordBatch:
            keys, n = (np.concatenate([*columns, np.empty(0, np.int64)]) for columns in (zip(*held) if held else ([], [])))
            context, symbol = contexts.take("key", keys >> BITS) if contexts else keys >> BITS, keys & MASK
            many = n > 1
            single, times = np.unique(context[~many], return_counts=True)
            below = np.exp(tree.suffix_logs(context[many] & MASK, symbol[many]))
            columns = (context[many], single), (symbol[many], np.full(len(single), -1)), (n[many], times), (below, np.zeros(len(single)))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["context", "symbol", "n", "below"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += len(batch)
            if size > HELD_PER_TASK:
                yield out()
                held, size = [], 0
        yield out()

    return materialise(found.mapInArrow(run, "context long, symbol long, n long, below double"), "told")


def _level(rows: DataFrame) -> Level:
    """States and listed probabilities from the rows of ``_told``."""
    n, below, single = F.col("n"), F.col("below"), F.col("symbol") < 0
    sums = [F.sum("n").alias("all"), F.sum(F.when(single, n).otherwise(1)).alias("kinds"), F.sum(F.when(single, n).otherwise(0)).alias("singles")]
    per = rows.groupBy(F.col("context").alias("_context")).agg(*sums).filter(F.col("all") >= MIN_COUNT)
    joined = rows.filter(~single).join(small_side(materialise(per, "contexts")), F.col("context") == F.col("_context")).drop("_context")
    others = F.col("all") - 1 + F.col("kinds")
    ratio = (n - 1 + F.col("kinds") * below) / others / below
    sums = [F.sum(n * F.log(ratio)).alias("sum"), *[F.max(c).alias(c) for c in ("all", "kinds", "singles")]]
    # Of a symbol that occurs once nothing is left without it, so its ratio is the same whatever it is.
    divergence = (F.col("sum") + F.col("singles") * F.log(F.col("kinds") / others)) / F.col("all")
    kept = joined.groupBy("context").agg(*sums).filter(divergence >= MIN_DIVERGENCE).select(F.col("context").alias("_context"))
    own = (n + F.col("kinds") * below) / (F.col("all") + F.col("kinds"))
    listed = joined.join(small_side(materialise(kept, "states")), F.col("context") == F.col("_context"), "left_semi").withColumn("own", own)
    listed = materialise(listed.filter(n * F.abs(F.log(F.col("own") / below)) > 0).select("context", "symbol", "own", "below"), "listed")
    left = [F.log(F.greatest(1 - F.sum(c), F.lit(1e-12))) for c in ("own", "below")]
    states = materialise(listed.groupBy(F.col("context").alias("key")).agg((left[0] - left[1]).alias("rest")), "states")
    held = stored(states, states.count(), "states")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, _ = held.find(batch.column(0).to_numpy())
            keys = (place << BITS) | batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.log(batch.column(2).to_numpy()))], ["key", "log"])

    return Level(held, stored(listed.mapInArrow(placed, "key long, log double"), listed.count(), "entries"))


def train(rows: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree of the training rows (text), and the counts of all their words (key, n)."""
    spark = rows.sparkSession
    counts = materialise(count_words(rows), "word-counts")
    ends = rows.count()
    words, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = _at_most(counts, "n", FREQUENT).toArrow()  # at most FREQUENT rows
    keys, amounts = (top.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))
    order = np.lexsort((keys, -amounts))
    keys, amounts = keys[order], amounts[order]
    places = np.argsort(keys)
    others = counts.join(F.broadcast(spark.createDataFrame(pa.table({"key": keys}))), "key", "left_anti")
    tree = Tree(keys[places], places + FIRST_WORD, amounts, stored(others, kinds - len(keys), "words"), ends, int(words) + ends, kinds + bool(ends))

    def pairs(texts: list[str], known: tuple[Tree, None]) -> np.ndarray:
        ids, ends = known[0].symbols(texts)
        before, _ = Tree.past(ids, ends)
        often = np.where(before == START, known[0].ends, known[0].counts(before)) >= MIN_COUNT
        return (before[often] << BITS) | ids[often]

    known = sent(spark, (tree, None))
    found = _told(count_keys(rows, pairs, known), known)
    tree.one = _level(found)
    after = F.shiftleft("context", BITS).bitwiseOR(F.col("symbol"))
    chosen = found.filter((F.col("n") >= MIN_COUNT) & (F.col("symbol") > END)).select(after.alias("key"))
    contexts = stored(chosen, chosen.count(), "contexts")

    def triples(texts: list[str], known: tuple[Tree, Table]) -> np.ndarray:
        tree, contexts = known
        ids, ends = tree.symbols(texts)
        _, two = Tree.past(ids, ends)
        place, there = contexts.find(two)
        return (place[there] << BITS) | ids[there]

    known = sent(spark, (tree, contexts))
    tree.two = _level(_told(count_keys(rows, triples, known), known))
    return tree, counts


def score_texts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities) for every row."""
    rows = docs.select(F.col(id).alias("doc_id"), held_out(id).alias("held_out"), whole(text).alias("text"))
    tree, _ = train(rows.filter("not held_out").select("text"))
    with_tree = sent(docs.sparkSession, tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = cloudpickle.loads(with_tree.value)
        for batch in batches:
            low = 0
            for texts in _chunks(batch.column(2).to_pylist()):
                ids, ends = tree.symbols(texts)
                starts = np.concatenate(([0], ends[:-1]))
                known = (ids >= FIRST_WORD) | ((ids == END) & (tree.ends > 0))
                sums = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), tree.root_logs(ids), tree.logs(ids, ends))]
                own = [batch.column(k).slice(low, len(texts)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(ends - starts), *map(pa.array, sums)], ["doc_id", "held_out", "n_tokens", "n_known", "base", "logs"])
                low += len(texts)

    kind = rows.schema["doc_id"].dataType.simpleString()
    told = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, logs double")
    to_ten = 1 / math.log(10)
    scores = ((F.col("base") * to_ten).alias("base_score"), (F.col("logs") * to_ten).alias("score"))
    return told.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tree.total).cast("long").alias("train_tokens"), *scores)
