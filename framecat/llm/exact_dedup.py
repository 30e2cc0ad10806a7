"""Exact duplicates by an exchange of Golomb-coded fingerprints.

A sender is a run of at most SENDER_ROWS rows of one partition. It sends the sorted
distinct fingerprints of its rows, cut to a range a little above the number of rows and
Golomb coded, to the owners of their ranges. An owner merges what it receives and answers
each sender with a bitmap of the fingerprints that another sender has too. Rows so marked,
and rows whose fingerprint their own sender holds twice, are suspects; only their texts
are shuffled, and compared byte by byte. A group with a third of all rows is one
fingerprint per sender, and one text per partition after the map-side grouping.

Defined results: null texts are empty texts, and equal to each other and to texts of white
space; of tied rows the smallest id stays, a null id last; of rows that repeat with id and
text, one stays. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecat.llm import golomb
from framecat.llm.common import keep, raw_hash, small_side, whole, without_white
from framecat.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a sender are numbered by this many low bits: 262,144 at most.
SENDER_BITS = 18
#: Rows that one owner looks after, on average.
OWNER_ROWS = 1 << 20
#: Spare bits of a cut fingerprint: one unique text in 2**8 becomes a suspect for nothing.
SPARE_BITS = 8


def _narrow(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Hashes of every row; written once, so that row numbers hold from here on."""
    norm = without_white(whole(text))
    rows = docs.select(
        F.col(id).alias("doc_id"),
        raw_hash(text).alias("raw"),
        F.unhex(F.sha2(norm, 256)).alias("sha"),
        F.xxhash64(norm).alias("fingerprint"),
        F.char_length(whole(text)).alias("points"),
        F.monotonically_increasing_id().alias("row"),
    )
    return materialise(rows.withColumn("sender", F.shiftright("row", SENDER_BITS)), "fingerprints")


def _cut(table: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cut fingerprints of a sender, for each row the place of its own, and their counts."""
    hashes = table.column("fingerprint").to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)
    found, place, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return found, place, counts


def _messages(rows: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    shift = np.uint64(bits - owner_bits)

    def send(table: pa.Table) -> pa.Table:
        found, _, _ = _cut(table, bits)
        owners = (found >> shift).astype(np.int64)
        starts = np.flatnonzero(np.diff(owners, prepend=-1))
        sender, out = table.column("sender")[0].as_py(), []
        for low, high in zip(starts, [*starts[1:], len(found)]):
            owner = int(owners[low])
            values = found[low:high] - (np.uint64(owner) << shift)
            fixed = golomb.parameter(values, 1 << int(shift))
            out.append((sender, owner, len(values), fixed, golomb.encode(values, fixed)))
        names = ("sender", "owner", "n", "fixed", "codes")
        return pa.table(dict(zip(names, map(list, zip(*out)))), schema=_MESSAGE)

    return rows.select("sender", "fingerprint").groupBy("sender").applyInArrow(
        send, "sender long, owner long, n int, fixed int, codes binary"
    )


_MESSAGE = pa.schema(
    [("sender", pa.int64()), ("owner", pa.int64()), ("n", pa.int32()), ("fixed", pa.int32()), ("codes", pa.binary())]
)


def _answer(table: pa.Table) -> pa.Table:
    """For each sender a bitmap of its fingerprints that another sender holds too."""
    held = [golomb.decode(m["codes"], m["fixed"], m["n"]) for m in table.to_pylist()]
    _, place, counts = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    many = np.split(counts[place] > 1, np.cumsum([len(x) for x in held])[:-1])
    bitmaps = [np.packbits(x).tobytes() for x in many]
    return pa.table({"sender": table.column("sender"), "owner": table.column("owner"), "n": table.column("n"), "bitmap": pa.array(bitmaps, pa.binary())})


def _marked(rows: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    def mark(table: pa.Table, answers: pa.Table) -> pa.Table:
        found, place, counts = _cut(table, bits)
        told = sorted(answers.to_pylist(), key=lambda a: a["owner"])
        many = [np.unpackbits(np.frombuffer(a["bitmap"], np.uint8))[: a["n"]] for a in told]
        many = np.concatenate(many).astype(bool) if many else np.zeros(0, bool)
        return table.append_column("suspect", pa.array((many | (counts > 1))[place]))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.groupBy("sender").cogroup(bitmaps.groupBy("sender")).applyInArrow(mark, f"{fields}, suspect boolean")


def _texts_per_hash(docs: DataFrame, suspects: DataFrame, id: str, text: str) -> DataFrame:
    """Compares the suspects' texts: for each SHA-256 the number of different texts that have it."""
    ids = materialise(suspects.select(F.col("doc_id").alias("_id")).distinct(), "suspects")
    picked = docs.select(id, text).join(small_side(ids), docs[id].eqNullSafe(F.col("_id")), "left_semi")
    norm = without_white(whole(text))
    texts = picked.select(F.unhex(F.sha2(norm, 256)).alias("sha"), norm.alias("norm")).distinct()
    return texts.groupBy("sha").agg(F.count(F.lit(1)).alias("texts"))


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, raw, keep_id, group_size, kept, text_sha256 for every row.

    The row that stays has the most code points in its own text, then the smallest id. Two
    different texts under one SHA-256, which nobody has seen, would stop the job.
    """
    rows = _narrow(docs, id, text)
    count = rows.count()
    owner_bits = max(0, math.ceil(math.log2(max(1, count / OWNER_ROWS))))
    bits = min(62, max(owner_bits + 1, math.ceil(math.log2(count + 1)) + SPARE_BITS))
    bitmaps = _messages(rows, bits, owner_bits).groupBy("owner").applyInArrow(
        _answer, "sender long, owner long, n int, bitmap binary"
    )
    marked = materialise(_marked(rows, bitmaps, bits), "marked")
    suspects = marked.filter("suspect")
    best = F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = suspects.groupBy("sha").agg(F.count(F.lit(1)).alias("_n"), F.min(best).alias("_best"))
    checked = groups.filter("_n > 1").join(_texts_per_hash(docs, suspects, id, text), "sha")
    one = F.when(F.col("texts") == 1, F.col("_n")).otherwise(F.raise_error(F.lit("two texts have one SHA-256")).cast("long"))
    classes = checked.select(
        F.col("sha").alias("_sha"), one.alias("_size"), F.col("_best.doc_id").alias("_keep"), F.col("_best.row").alias("_row")
    )
    classes = materialise(classes, "classes")
    told = marked.join(small_side(classes), F.col("sha") == F.col("_sha"), "left")
    return told.select(
        "doc_id",
        "raw",
        F.when(F.col("_sha").isNull(), F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, all columns, with one row of each group."""
    return keep(docs, exact_duplicates(docs, id, text).withColumnRenamed("doc_id", id), id, text)
