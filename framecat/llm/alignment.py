"""Alignment of two tokenizers' tokens by an associative composition of fragments.

Tokens of both tokenizers cover the bytes of a text; offsets where a token of each ends cut
them into groups, the smallest parts that both spell with whole tokens. A range of bytes,
with the tokens that end in it, is a ``Fragment``: an open prefix (tokens up to the first
common end), the groups closed after it, and an open suffix (tokens after the last common
end). ``Fragment.then`` composes neighbours: the suffix of one and the prefix of the next
close one group. It is associative and the empty fragment is neutral, so any tree gives the
same result.

1. Documents below CHUNK bytes are encoded whole, and those of a slice of a batch are aligned
   side by side: all their ends are marked in one array of bytes.
2. Longer documents become byte ranges of CHUNK bytes, rows of their own that are worked on in
   different tasks. Neither tokenizer can join over a blank between two characters that are
   no white space, so a range is encoded from the last such cut before it to the first one
   after it, and keeps the tokens that end in it; its edges fall inside groups. Fragments of FAN
   neighbours are composed per round until one is left for each document. A stretch
   longer than CHUNK without a cut stays in one range: its tokens depend on all of it.
3. A link is a pair of a token of each side that share a byte. Every document keeps its links
   folded by id pair; their sums over the corpus are looked up for a second pass. They are
   broadcast while there are at most LOOKUP_ROWS pairs, else they are joined.

Defined results: null and empty texts have no tokens, nor have texts that one side's tokens do
not spell byte for byte (a U+2581 in the text, say). A null id is an id like others; rows that
repeat id and text each have their result. Strings of special tokens in texts are plain text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from framecat.llm.common import raw_hash, sent, small_side, whole
from framecat.session import materialise, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK, FAN = 1 << 16, 8
LOOKUP_ROWS = 4_000_000
SLICE_CHARS = 1 << 21
BLANK = "▁"
# Fixed value: how byte-level vocabularies split texts into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: No cut beside these; white space is what Python takes for it.
UNSAFE = re.compile(rf"[\s{BLANK}]")
def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies spell bytes by letters: printable bytes by themselves, others by letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Sides:
    """Both tokenizers: a byte-level file of ``tokenizers`` and a model of ``sentencepiece``; a few MB."""

    a_file: bytes
    b_file: bytes

    def load(self) -> "Encoders":
        return Encoders(self)


def read_sides(a_path: str, b_path: str) -> Sides:
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(f.read())
    return Sides(*files)


class Encoders:
    """Ids of units by both sides, and the bytes of every id."""

    def __init__(self, sides: Sides):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(sides.a_file.decode())
        self.a.encode_special_tokens = True
        self.fast = self.ranked(json.loads(sides.a_file))
        self.b = sentencepiece.SentencePieceProcessor(model_proto=sides.b_file)
        letters = byte_of_letter()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            spelled = all(c in letters for c in piece)
            self.a_bytes[i] = bytes(letters[c] for c in piece) if spelled else piece.encode()
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace(BLANK, " ").encode() for p, byte in pieces]
        if any(BLANK in p.lstrip(BLANK) for p, _ in pieces):
            raise ValueError("a piece crosses a blank")
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.spelled = [pa.array(t, pa.binary()) for t in (self.a_bytes, self.b_bytes)]
        self.named = [pa.array([str(i) for i in range(len(t))]) for t in (self.a_bytes, self.b_bytes)]

    @staticmethod
    def ranked(file: dict):
        """The same merges by rank, which encode seven times as fast; None where the file does not allow it."""
        import tiktoken

        model, words, letters = file["model"], file.get("pre_tokenizer") or {}, byte_of_letter()
        plain = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        vocabulary = model["vocab"]
        if not plain or file.get("normalizer") or model.get("ignore_merges") or any(vocabulary.get(m) != 256 + i for i, m in enumerate(merges)):
            return None
        special = {t["content"] for t in file.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items() if piece not in special}
        return tiktoken.Encoding("side-a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of a blank and the text by a, of the text by b (which puts the blank itself)."""
        if self.fast:
            a = [self.fast.encode_ordinary(" " + t) for t in texts]
        else:
            a = [e.ids for e in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)

    def spells(self, unit: str, a: list[int], b: list[int]) -> bool:
        data = (" " + unit).encode()
        return b"".join([self.a_bytes[i] for i in a]) == data and b"".join([self.b_bytes[i] for i in b]) == data


@dataclass
class Tokens:
    """Ids and end offsets of both sides."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: "Tokens") -> "Tokens":
        return Tokens(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in FIELDS))

    def between(self, low: int, high: int) -> "Tokens":
        """Those that end in (low, high]."""
        a, b = ((ends > low) & (ends <= high) for ends in (self.a_ends, self.b_ends))
        return Tokens(self.a[a], self.a_ends[a], self.b[b], self.b_ends[b])

    def common(self) -> np.ndarray:
        return np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)

    def links(self) -> np.ndarray:
        """The id pair of every link: between neighbouring ends of either side one token of each covers the bytes."""
        ends = np.union1d(self.a_ends, self.b_ends)
        a, b = self.a[np.searchsorted(self.a_ends, ends)], self.b[np.searchsorted(self.b_ends, ends)]
        return (a.astype(np.int64) << 32) | b

    def listed(self, common: np.ndarray) -> list[str]:
        """A text for each group that ends at a common end."""
        cuts_a, cuts_b = np.searchsorted(self.a_ends, common, "right"), np.searchsorted(self.b_ends, common, "right")
        a, b, out, i, j = self.a.tolist(), self.b.tolist(), [], 0, 0
        for x, y in zip(cuts_a.tolist(), cuts_b.tolist()):
            out.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        return out


FIELDS = ("a", "a_ends", "b", "b_ends")


def no_tokens() -> Tokens:
    return Tokens(*(np.empty(0, np.int64) for _ in FIELDS))


@dataclass
class Closed:
    """Closed groups: their texts, how many tokens, and their links by id pair."""

    texts: list[str] = field(default_factory=list)
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @classmethod
    def of(cls, tokens: Tokens) -> "Closed":
        if not len(tokens.a):
            return cls()
        common = tokens.common()
        keys, times = np.unique(tokens.links(), return_counts=True)
        return cls([";".join(tokens.listed(common))], len(tokens.a), len(tokens.b), len(common), keys, times)

    def then(self, other: "Closed") -> "Closed":
        keys, place = np.unique(np.concatenate([self.keys, other.keys]), return_inverse=True)
        times = np.bincount(place, np.concatenate([self.times, other.times]), len(keys)).astype(np.int64)
        return Closed(self.texts + other.texts, self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups, keys, times)


@dataclass
class Fragment:
    """What a byte range tells: tokens before its first common end, closed groups, tokens after the last one.

    Without a common end (``met`` false) all tokens are in the prefix.
    """

    prefix: Tokens
    closed: Closed
    suffix: Tokens
    met: bool

    @classmethod
    def of(cls, tokens: Tokens) -> "Fragment":
        common = tokens.common()
        if not len(common):
            return cls(tokens, Closed(), no_tokens(), False)
        first, last = int(common[0]), int(common[-1])
        end = max(tokens.a_ends[-1], tokens.b_ends[-1])
        return cls(tokens.between(-1, first), Closed.of(tokens.between(first, last)), tokens.between(last, end), True)

    def then(self, other: "Fragment") -> "Fragment":
        if self.met and other.met:
            closed = self.closed.then(Closed.of(self.suffix + other.prefix)).then(other.closed)
            return Fragment(self.prefix, closed, other.suffix, True)
        if self.met:
            return Fragment(self.prefix, self.closed, self.suffix + other.prefix, True)
        return Fragment(self.prefix + other.prefix, other.closed, other.suffix, other.met)

    def ended(self) -> Closed:
        """All groups of a whole text, whose start is a common end too."""
        return Closed.of(self.prefix).then(self.closed)


def no_fragment() -> Fragment:
    return Fragment(no_tokens(), Closed(), no_tokens(), False)


def stream(encoders: Encoders, text: str, start: int = 0) -> tuple[Tokens, bool]:
    """Tokens of a text whose blank in front is at an offset, and whether they spell it."""
    a, b = encoders.encode([text])
    one, two = np.array(a[0], np.int64), np.array(b[0], np.int64)
    tokens = Tokens(one, start + np.cumsum(encoders.a_sizes[one]), two, start + np.cumsum(encoders.b_sizes[two]))
    return tokens, encoders.spells(text, a[0], b[0])


def _joined(strings: pa.Array, ends: np.ndarray, by: str) -> pa.Array:
    """Neighbouring strings joined up to each end."""
    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, strings), by)


def side_by_side(encoders: Encoders, texts: list[str]) -> list[pa.Array]:
    """n_a, n_b, n_groups, groups, keys, times of texts that are not empty."""
    sides = encoders.encode(texts)
    data = [(" " + t).encode() for t in texts]
    size = np.array([len(d) for d in data], np.int64)
    counts = [np.array([len(ids) for ids in side], np.int64) for side in sides]
    flat = []
    for side in sides:
        ids = array("i")
        for one in side:
            ids.extend(one)
        flat.append(np.frombuffer(ids, np.int32).astype(np.int64))
    fits = _fit(encoders, texts, sides, data, flat, counts, size)
    if not fits.all():
        flat = [ids[np.repeat(fits, n)] for ids, n in zip(flat, counts)]
        counts, size = [np.where(fits, n, 0) for n in counts], np.where(fits, size, 0)
    bounds = np.cumsum(size)
    total = int(bounds[-1])
    marks = np.zeros(total + 1, np.uint8)
    for bit, ids, sizes in zip((1, 2), flat, (encoders.a_sizes, encoders.b_sizes)):
        marks[np.cumsum(sizes[ids])] |= bit
    ends = np.flatnonzero(marks)
    at = marks[ends]
    # How many tokens end before each end is the place of the token that covers the bytes before it.
    upto = [np.cumsum((at & bit) > 0) for bit in (1, 2)]
    before = [np.concatenate(([0], u[:-1])) if len(u) else u for u in upto]
    common = at == 3
    listed = [_joined(names.take(pa.array(ids)), u[common], ",") for names, ids, u in zip(encoders.named, flat, upto)]
    groups = pc.binary_join_element_wise(listed[0], listed[1], "|")
    own = np.searchsorted(ends, bounds, "right")  # ends up to each text's own
    met = np.concatenate(([0], np.cumsum(common)))[own]
    wide = len(encoders.b_sizes)
    links = flat[0][before[0]] * wide + flat[1][before[1]] if len(ends) else np.empty(0, np.int64)
    pairs = len(encoders.a_sizes) * wide
    owner = np.repeat(np.arange(len(texts)), np.diff(own, prepend=0))
    told, times = np.unique(owner * pairs + links, return_counts=True)
    per = pa.array(np.searchsorted(told, np.arange(len(texts) + 1) * pairs).astype(np.int32))
    keys = pa.ListArray.from_arrays(per, pa.array(told % pairs))
    return [
        *(pa.array(n) for n in counts),
        pa.array(np.diff(met, prepend=0)),
        _joined(groups, met, ";"),
        keys,
        pa.ListArray.from_arrays(per, pa.array(times.astype(np.int32))),
    ]


def _fit(encoders: Encoders, texts: list[str], sides, data: list[bytes], flat, counts, size: np.ndarray) -> np.ndarray:
    """Which texts are spelled by the tokens of both sides; told apart only where they are not all."""
    together = pa.py_buffer(b"".join(data))
    for table, sizes, ids, n in zip(encoders.spelled, (encoders.a_sizes, encoders.b_sizes), flat, counts):
        ends = np.concatenate(([0], np.cumsum(sizes[ids])))[np.concatenate(([0], np.cumsum(n)))]
        spelled = _joined(table.take(pa.array(ids)), np.array([len(ids)]), b"")[0].as_buffer()
        if (np.diff(ends) != size).any() or not spelled.equals(together):
            return np.fromiter(map(encoders.spells, texts, *sides), bool, len(texts))
    return np.ones(len(texts), bool)


def _sums(counts: "Counts", keys: pa.Array, times: pa.Array) -> pa.Array:
    """n_links, n_best and count_sum of each list of links."""
    flat, n = keys.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    best, total = counts.of(flat)
    ends = np.cumsum(pc.list_value_length(keys).to_numpy(zero_copy_only=False).astype(np.int64))
    told = [np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], ends))]) for x in (n, n * best, n * total)]
    return pa.StructArray.from_arrays([pa.array(t) for t in told], ["n_links", "n_best", "count_sum"])


@dataclass
class Counts:
    """Links by id pair over the corpus, sorted by pair."""

    keys: np.ndarray
    times: np.ndarray
    best: np.ndarray

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a pair is the most frequent of its b, and how frequent it is."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        # Pairs that only texts without tokens have are not counted; what they get is not used.
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.best[place].astype(np.int64), self.times[place]


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    edges = np.flatnonzero(np.diff(sizes // SLICE_CHARS, prepend=0))
    for low, high in zip([0, *edges], [*edges, len(batch)]):
        if high > low:
            yield batch.slice(low, high - low)


def _short(docs: DataFrame, shared, key: str) -> DataFrame:
    """doc_id, raw, n_a, n_b, n_groups, groups, keys, times of documents below CHUNK bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = cloudpickle.loads(shared.value).load()
        for batch in batches:
            for part in _slices(batch, "text"):
                told = side_by_side(encoders, part.column("text").to_pylist())
                told[4] = told[4].cast(pa.list_(pa.int32() if key == "int" else pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *told], ALIGNED)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "raw", "text").mapInArrow(run, _aligned_shape(kind, key))


def _aligned_shape(id_kind: str, key: str) -> str:
    return f"doc_id {id_kind}, raw long, n_a long, n_b long, n_groups long, groups string, keys array<{key}>, times array<int>"


ALIGNED = ["doc_id", "raw", "n_a", "n_b", "n_groups", "groups", "keys", "times"]


def _is_cut(data: bytes, place: int) -> bool:
    """Whether the blank at a place lies between two characters that are no white space."""
    before = data[max(0, place - 4) : place].decode("utf-8", "ignore")[-1:]
    after = data[place + 1 : place + 5].decode("utf-8", "ignore")[:1]
    return bool(before and after) and not UNSAFE.match(before) and not UNSAFE.match(after)


def _cut_near(data: bytes, edge: int, chunk: int) -> tuple[int, int] | None:
    """The cuts around an edge, if they are at most ``chunk`` apart."""
    low = edge
    while low > max(0, edge - chunk):
        low = data.rfind(b" ", max(0, edge - chunk), low)
        if low < 0 or (low > 0 and _is_cut(data, low)):
            break
    low = 0 if edge <= chunk and low < 0 else low
    high = edge
    while True:
        high = data.find(b" ", high, edge + chunk)
        if high < 0 or _is_cut(data, high):
            break
        high += 1
    high = len(data) if high < 0 and edge + chunk >= len(data) else high
    return (low, high) if low >= 0 and high >= 0 and high - low <= chunk and (low == 0 or _is_cut(data, low)) else None


def ranges(data: bytes, chunk: int) -> list[tuple[int, int, int, int]]:
    """begin, end, and the whole units around them for each byte range of a text (with its blank in front)."""
    edges = [(e, near) for e in range(chunk, len(data), chunk) if (near := _cut_near(data, e, chunk))]
    edges = [(0, (0, 0)), *edges, (len(data), (len(data), len(data)))]
    return [(a, b, low, high) for (a, (low, _)), (b, (_, high)) in zip(edges, edges[1:])]


FRAGMENT = (
    "fits boolean, met boolean, n_a long, n_b long, n_groups long, groups string, keys array<long>, times array<long>, "
    + ", ".join(f"{side}_{f} array<long>" for side in ("prefix", "suffix") for f in FIELDS)
)


def _packed(f: Fragment, fits: bool) -> dict:
    told = {"fits": fits, "met": f.met, "n_a": f.closed.n_a, "n_b": f.closed.n_b, "n_groups": f.closed.n_groups}
    told |= {"groups": ";".join(f.closed.texts), "keys": f.closed.keys, "times": f.closed.times}
    return told | {f"{side}_{name}": getattr(getattr(f, side), name) for side in ("prefix", "suffix") for name in FIELDS}


def _unpacked(row: dict) -> Fragment:
    ints = lambda name: np.array(row[name], np.int64)
    closed = Closed([row["groups"]] if row["n_groups"] else [], row["n_a"], row["n_b"], row["n_groups"], ints("keys"), ints("times"))
    sides = [Tokens(*(ints(f"{side}_{name}") for name in FIELDS)) for side in ("prefix", "suffix")]
    return Fragment(sides[0], closed, sides[1], row["met"])


def _shape(id_type) -> pa.Schema:
    types = {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in FRAGMENT.split(", ")]
    return pa.schema([("doc_id", to_arrow_type(id_type)), ("raw", pa.int64()), ("chunk", pa.int64()), *((n, types[t]) for n, t in fields)])


def fragments(docs: DataFrame, shared, chunk: int) -> DataFrame:
    """Composed fragment of each document (doc_id, raw, text): byte ranges, then rounds of FAN neighbours."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape, columns = _shape(docs.schema["doc_id"].dataType), f"doc_id {kind}, raw long, chunk long, {FRAGMENT}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                data = b" " + row.column(2)[0].as_buffer().to_pybytes()
                for i, (begin, end, low, high) in enumerate(ranges(data, chunk)):
                    told = [row.column(0), row.column(1), *(pa.array([x], pa.int64()) for x in (i, begin, end, low))]
                    yield pa.RecordBatch.from_arrays([*told, pa.array([data[low:high].decode()], pa.string())], ["doc_id", "raw", "chunk", "begin", "end", "low", "part"])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = cloudpickle.loads(shared.value).load()
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                tokens, fits = stream(encoders, row["part"][1:], row["low"])
                found = Fragment.of(tokens.between(row["begin"], row["end"])) if fits else no_fragment()
                told = {"doc_id": row["doc_id"], "raw": row["raw"], "chunk": row["chunk"]} | _packed(found, fits)
                yield pa.RecordBatch.from_pylist([told], schema=shape)

    def composed(table: pa.Table) -> pa.Table:
        rows = table.sort_by("chunk").to_pylist()
        found = no_fragment()
        for row in rows:
            found = found.then(_unpacked(row))
        told = {"doc_id": rows[0]["doc_id"], "raw": rows[0]["raw"], "chunk": rows[0]["chunk"] // FAN}
        return pa.Table.from_pylist([told | _packed(found, all(r["fits"] for r in rows))], schema=shape)

    cuts = docs.mapInArrow(cut, f"doc_id {kind}, raw long, chunk long, begin long, end long, low long, part string")
    cuts = materialise(cuts, "ranges")
    most = (cuts.agg(F.max("chunk")).first()[0] or 0) + 1
    # Ranges of one document go to many tasks.
    told = cuts.repartition("doc_id", "raw", "chunk").mapInArrow(aligned, columns)
    told = materialise(told, "fragments")
    while most > 1:
        told = told.groupBy("doc_id", "raw", F.expr(f"chunk div {FAN}")).applyInArrow(composed, columns)
        told = materialise(told, "fragments")
        most = -(-most // FAN)
    return told


def _ended(found: DataFrame, wide: int, key: str) -> DataFrame:
    """doc_id, raw, n_a, n_b, n_groups, groups, keys, times of whole documents."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                read = row.to_pylist()[0]
                closed = _unpacked(read).ended() if read["fits"] else Closed()
                numbers = [pa.array([x], pa.int64()) for x in (closed.n_a, closed.n_b, closed.n_groups)]
                keys = (closed.keys >> 32) * wide + (closed.keys & 0xFFFFFFFF)
                lists = [pa.array([keys], pa.list_(pa.int32() if key == "int" else pa.int64())), pa.array([closed.times], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([row.column(0), row.column(1), *numbers, pa.array([";".join(closed.texts)]), *lists], ALIGNED)

    return found.mapInArrow(run, _aligned_shape(kind, key))


def _stored(df: DataFrame, label: str) -> DataFrame:
    """As ``materialise``, packed tighter: listings are longer than texts."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def align(docs: DataFrame, sides: Sides, id: str = "doc_id", text: str = "text", chunk: int = CHUNK, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (`a1,a2|b1;a3|b2`, ids in order) of every row."""
    spark: SparkSession = docs.sparkSession
    shared = sent(spark, sides)
    encoders = sides.load()
    wide = len(encoders.b_sizes)
    key = "int" if len(encoders.a_sizes) * wide < 2**31 else "long"
    rows = docs.select(F.col(id).alias("doc_id"), raw_hash(text).alias("raw"), whole(text).alias("text"))
    empty, long = F.col("text") == "", F.octet_length("text") >= chunk
    # Long rows that repeat are worked on once and get their results by a join.
    once = rows.filter(long).dropDuplicates(["doc_id", "raw"])
    ended = materialise(_ended(fragments(once, shared, chunk), wide, key), "ended").withColumnsRenamed({"doc_id": "_id", "raw": "_raw"})
    lengthy = rows.filter(long).select("doc_id", "raw")
    lengthy = lengthy.join(ended, lengthy["doc_id"].eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw"))).select(*ALIGNED)
    aligned = _stored(_short(rows.filter(~empty & ~long), shared, key).unionByName(lengthy), "aligned")

    links = aligned.select(F.inline(F.arrays_zip("keys", "times"))).withColumnRenamed("keys", "key")
    counts = materialise(links.groupBy("key").agg(F.sum("times").alias("total")), "links")
    of_b = counts.withColumn("b", F.col("key") % wide)
    highest = of_b.groupBy("b").agg(F.max("total").alias("most"))
    counts = materialise(of_b.join(highest, "b").select("key", "total", (F.col("total") == F.col("most")).alias("best")), "counts")
    if counts.limit(lookup_rows + 1).count() <= lookup_rows:
        table = counts.orderBy("key").toArrow()
        held = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("key", "total", "best")))

        @F.arrow_udf("struct<n_links: long, n_best: long, count_sum: long>")
        def sums(keys: pa.Array, times: pa.Array) -> pa.Array:
            return _sums(Counts(*held.value), keys, times)

        told = aligned.withColumn("s", sums("keys", "times")).select(*ALIGNED[:6], "s.*")
    else:
        # Texts without links keep their row; equal rows have equal sums.
        folded = aligned.dropDuplicates(["doc_id", "raw"]).select("doc_id", "raw", F.inline(F.arrays_zip("keys", "times"))).withColumnRenamed("keys", "key")
        joined = folded.join(small_side(counts), "key")
        sums = joined.groupBy("doc_id", "raw").agg(
            F.sum("times").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("total")).alias("count_sum"),
        )
        sums = sums.withColumnsRenamed({"doc_id": "_id", "raw": "_raw"})
        told = aligned.join(sums, aligned["doc_id"].eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw")), "left")
        told = told.select(*ALIGNED[:6], *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_links", "n_best", "count_sum")))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    nothing = rows.filter(empty).select("doc_id", "raw", *(F.lit(0).cast("long").alias(c) for c in names), F.lit("").alias("groups"))
    return told.select("doc_id", "raw", *names, "groups").unionByName(nothing)
