"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A text is cut into units that no piece crosses (a run of blanks and what follows it up to
the next blank; line ends apart). The different units of a slice of a batch that are not yet
known are grouped by length, and units of one length advance together: hashes of all their
substrings probe the sorted piece keys, and for each end the best of all lengths is a
maximum over one matrix row, whose place is the backpointer. Of tied paths the one with the
longest last piece wins. Characters that no piece holds are spelled in bytes.

The result is the segmentation with the highest sum of piece scores, which is what the
format's unigram search gives for these pieces. A file made by merging, such as the one the
query uses, has ranks for scores (see ``piece_scores``), and its merge order can give another
segmentation, which decodes to the same text.

Defined results: null and empty texts have no tokens; U+2581, which stands for a blank in
pieces, decodes to a blank. Very long words are cut into strips of ends, so memory is
bounded by STRIP, not by the word; a known unit is kept until KNOWN_UNITS are.
"""

from __future__ import annotations

import math
import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.llm.common import whole

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
# Fixed values of the model format: kinds of pieces, and what an unknown character costs.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
MERGED = 2
UNKNOWN_PENALTY = 10.0
BASE = np.uint64(0x9E3779B97F4A7C15)
STRIP = 1 << 20
SLICE_CHARS = 1 << 21
KNOWN_UNITS = 300_000


@dataclass
class Pieces:
    """The tables of a model, a few hundred bytes a piece; they travel with the tasks."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    unknown: float
    bytes_to_ids: list[int]
    spelled: list[bytes]
    unit: str
    plain: bool


def _key(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(BASE) + ord(c) + 1) & (2**64 - 1)
    return h


def piece_scores(model) -> list[float]:
    """The file's scores, or for a file made by merging, whose scores are ranks, logarithms of ranks.

    A sum of ranks prefers many early pieces to one later piece that spells the same; the
    share of the piece of rank r is near 1 / r, by Zipf's law, and such shares can be multiplied.
    """
    if model.trainer_spec.model_type != MERGED:
        return [p.score for p in model.pieces]
    ranked = sorted((-p.score, i) for i, p in enumerate(model.pieces) if p.type == NORMAL)
    scores, total = [0.0] * len(model.pieces), math.log(sum(1 / (r + 2) for r in range(len(ranked))))
    for rank, (_, i) in enumerate(ranked):
        scores[i] = -math.log(rank + 2) - total
    return scores


def load(path: str) -> Pieces:
    """Reads a model file whose texts are used as they are but for a blank in front."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    told = model.normalizer_spec
    if told.precompiled_charsmap or told.remove_extra_whitespaces or not told.add_dummy_prefix:
        raise ValueError("only models that leave texts as they are can be used")
    scores = piece_scores(model)
    normal = [s for s, p in zip(scores, model.pieces) if p.type == NORMAL]
    highest, rows, byte_ids, spelled = max(normal), [], [0] * 256, []
    for i, p in enumerate(model.pieces):
        if p.type == BYTE:
            byte_ids[int(p.piece[3:5], 16)] = i
            spelled.append(bytes([int(p.piece[3:5], 16)]))
            continue
        spelled.append(p.piece.replace(BLANK, " ").encode() if p.type in (NORMAL, USER_DEFINED) else b"")
        if p.type in (NORMAL, USER_DEFINED):
            inner = p.piece.lstrip(BLANK)
            if BLANK in inner:
                raise ValueError("a piece crosses a blank")
            own = len(p.piece.encode()) * highest - 0.1
            rows.append((_key(p.piece), i, scores[i] if p.type == NORMAL else own, len(p.piece)))
    plain = not any("\n" in p.piece for p in model.pieces)
    keys = np.array([r[0] for r in rows], np.uint64)
    order = np.argsort(keys)
    if len(np.unique(keys)) < len(keys):
        raise ValueError("two pieces have one key")
    return Pieces(
        keys[order],
        np.array([r[1] for r in rows], np.int32)[order],
        np.array([r[2] for r in rows])[order],
        max(r[3] for r in rows),
        min(normal) - UNKNOWN_PENALTY,
        byte_ids,
        spelled,
        f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n" if plain else f"{BLANK}*[^{BLANK}]+|{BLANK}+",
        plain,
    )


def _ending(table: Pieces, points: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """For ends low+1..high of words of one length: scores and ids of the piece of each length, longest first; -1 is unknown."""
    first = max(0, low - table.longest + 1)
    part = points[:, first:high].astype(np.uint64) + np.uint64(1)
    count, wide, most = part.shape[0], part.shape[1], table.longest
    scores = np.full((count, high - low, most), -np.inf)
    ids = np.full((count, high - low, most), -1, np.int32)
    hashes = np.zeros_like(part)
    for length in range(1, min(most, wide) + 1):
        starts = wide - length + 1
        hashes = hashes[:, :starts] * BASE + part[:, length - 1 :]
        skip = max(0, low + 1 - length - first)  # substrings that end at or before low
        probe = hashes[:, skip:]
        place = np.minimum(np.searchsorted(table.keys, probe), len(table.keys) - 1)
        hit = table.keys[place] == probe
        end = first + skip + length - 1 - low
        rows, cols = np.nonzero(hit)
        scores[rows, cols + end, most - length] = table.scores[place[rows, cols]]
        ids[rows, cols + end, most - length] = table.ids[place[rows, cols]]
    single = scores[:, :, most - 1]
    single[np.isneginf(single)] = table.unknown
    return scores, ids


def encode_units(table: Pieces, units: list[str]) -> dict[str, tuple[int, ...]]:
    by_length: dict[int, list[str]] = {}
    for unit in units:
        by_length.setdefault(len(unit), []).append(unit)
    told: dict[str, tuple[int, ...]] = {}
    for length, same in by_length.items():
        step = max(1, STRIP // (min(length, 4096) * table.longest))
        for at in range(0, len(same), step):
            told.update(_group(table, same[at : at + step], length))
    return told


def _group(table: Pieces, group: list[str], length: int) -> Iterator[tuple[str, tuple[int, ...]]]:
    """Units of one length side by side: forward maxima, then all backpointers followed at once."""
    most, rows = table.longest, np.arange(len(group))
    points = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32).reshape(len(group), length)
    best = np.full((len(group), length + most + 1), -np.inf)
    best[:, most] = 0.0
    back = np.empty((len(group), length), np.int8)
    taken = np.empty((len(group), length), np.int32)
    strip = max(1, STRIP // (len(group) * most))
    for low in range(0, length, strip):
        high = min(length, low + strip)
        scores, ids = _ending(table, points, low, high)
        for end in range(low, high):
            paths = best[:, end + 1 : end + 1 + most] + scores[:, end - low]
            place = paths.argmax(axis=1)
            best[:, end + 1 + most] = paths[rows, place]
            back[:, end] = most - place
            taken[:, end] = ids[rows, end - low, place]
    on_path = np.zeros((len(group), length), bool)
    place, live = np.full(len(group), length - 1), rows
    while len(live):
        on_path[live, place[live]] = True
        place[live] -= back[live, place[live]]
        live = live[place[live] >= 0]
    flat, ends = taken[on_path].tolist(), np.cumsum(on_path.sum(axis=1)).tolist()
    start = 0
    for unit, row, end in zip(group, range(len(group)), ends):
        ids = tuple(flat[start:end])
        start = end
        yield unit, ids if -1 not in ids else _spelled(table, unit, ids, np.flatnonzero(on_path[row]))


def _spelled(table: Pieces, unit: str, ids: tuple[int, ...], at: np.ndarray) -> tuple[int, ...]:
    """With the bytes of the characters that no piece holds."""
    told: list[int] = []
    for piece, place in zip(ids, at):
        told.extend((piece,) if piece >= 0 else [table.bytes_to_ids[b] for b in unit[place].encode()])
    return tuple(told)


def _units(table: Pieces, text: str) -> list[str]:
    if not text:
        return []
    if table.plain and "  " not in text and BLANK not in text and text[0] != " ":
        return (BLANK + text.replace(" ", " " + BLANK).replace("\n", " \n ")).split(" ")
    return re.findall(table.unit, BLANK + text.replace(" ", BLANK))


def encode_texts(table: Pieces, texts: list[str], known: dict[str, tuple[int, ...]]) -> tuple[array, list[int]]:
    """Ids of all texts in one array, and where each text ends in it."""
    units = [_units(table, text) for text in texts]
    every = set(chain.from_iterable(units))
    new = every - known.keys()
    if len(known) + len(new) > KNOWN_UNITS:
        known.clear()
        new = every
    known[""] = ()
    known.update(encode_units(table, sorted(new - {""})))
    ids, ends = array("i"), []
    for of in units:
        ids.extend(chain.from_iterable(map(known.__getitem__, of)))
        ends.append(len(ids))
    return ids, ends


def encode(docs: DataFrame, table: Pieces, text: str = "text", into: str = "token_ids") -> DataFrame:
    """docs without the text and with its token ids."""
    rows = docs.select(*[c for c in docs.columns if c != text], whole(text).alias(into))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(into)).to_numpy(zero_copy_only=False).astype(np.int64))
            edges = np.flatnonzero(np.diff(sizes // SLICE_CHARS, prepend=0))
            for low, high in zip([0, *edges], [*edges, len(batch)]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                ids, ends = encode_texts(table, part.column(into).to_pylist(), known)
                lists = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(np.frombuffer(ids, np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], part.schema.names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != into)
    return rows.mapInArrow(run, f"{kinds}, `{into}` array<int>")


def decode(rows: DataFrame, table: Pieces, ids: str = "token_ids", into: str = "text") -> DataFrame:
    """rows with the text of their token ids, ids kept."""
    spelled = table.spelled

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for one in batch.column(ids):
                told = b"".join(map(spelled.__getitem__, one.values.to_numpy().tolist())) if one.is_valid else b""
                texts.append(told.decode("utf-8", "replace").removeprefix(" "))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, `{into}` string")


def decodable(text: str | Column) -> Column:
    """The text as decoding gives it back."""
    return F.replace(whole(text), F.lit(BLANK), F.lit(" "))
