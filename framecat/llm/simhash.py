"""SimHash near duplicates by tiled exact comparison.

Documents become fingerprints in Arrow batches; equal fingerprints fold to one node before
anything is compared. Nodes lie in tiles by the population counts of their fingerprint's
parts. Two fingerprints within the radius differ in those counts by no more than the radius
in sum, so a tile meets only tiles that near; large tiles are cut into blocks of TILE_ROWS.
A pair of blocks is one group: exclusive-or and bit counts of numpy over strips. What leaves
a group is a minimum spanning forest of its links (at most one link per node), which keeps
every connection; no list of all pairs is written.

With more parts a tile is smaller and meets more tiles; parts grow with the number of
nodes, so that a tile of usual text stays near TILE_ROWS. Beyond a radius of about four
the counts exclude little, and the comparison is quadratic within its size classes
(``near_duplicates`` below), as the method is.

Defined results: null texts and texts without words have fingerprint zero and are linked
like any other; a null id is last when the smallest id is sought; repeated rows share a
component. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecat.llm.common import keep, raw_hash, same, small_side, whole
from framecat.llm.components import components
from framecat.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE_ROWS = 2048
SEED = 42
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Tiles that hold half of all random fingerprints, by the number of parts.
USUAL_TILES = {1: 11, 2: 90, 4: 3_000, 8: 500_000}
#: Near duplicates have shingle sets of this Jaccard similarity. Of 256 bits 39 differ there (48 between sets
#: of four and five), with a deviation of 6; within the radius pairs are candidates and their sets are compared.
NEAR_WORDS, NEAR_BITS, NEAR_RADIUS, NEAR_SIMILARITY = 5, 256, 72, 0.8
#: A block of sets has about so many of them and so many shingles; groups above it have so many pivots.
SET_ROWS, SET_SHINGLES, PIVOTS = 512, 1 << 19, 16
#: From so many sets on, overlaps are counted by matrix products, over so many shingles at a time.
DENSE_SETS, DENSE_SHINGLES = 16, 1 << 12


def _shingle_hashes(text: str, shingle: int) -> np.ndarray:
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[: len(words) - shingle] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)


def _spread(hashes: np.ndarray, word: int) -> np.ndarray:
    """The hash itself, or a further one made of it for the other words of wide fingerprints."""
    if not word:
        return hashes
    x = hashes ^ np.uint64((0x9E3779B97F4A7C15 * word) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str, shingle: int, bits: int = 64) -> tuple[bytes, int]:
    """The fingerprint, and the number of different shingles. A bit is set if set in over half of all."""
    hashes = _shingle_hashes(text, shingle)
    return _majority(hashes, bits), len(np.unique(hashes))


def _majority(hashes: np.ndarray, bits: int) -> bytes:
    if not len(hashes):
        return bytes(bits // 8)
    out = b""
    for word in range(bits // 64):
        ones = np.zeros(64, np.int64)
        for low in range(0, len(hashes), 1 << 15):
            part = _spread(hashes[low : low + (1 << 15)], word).astype(">u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
        out += np.packbits(2 * ones > len(hashes)).tobytes()
    return out


def fingerprints(docs: DataFrame, shingle: int, bits: int = 64, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, raw, code (bytes), shingles for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle, bits) for t in batch.column(2)]
            codes, counts = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.binary()), pa.array(counts, pa.int64())],
                ["doc_id", "raw", "code", "shingles"],
            )

    rows = docs.select(F.col(id).alias("doc_id"), raw_hash(text).alias("raw"), whole(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, raw long, code binary, shingles long")


def _shingle_set(text: str, shingle: int) -> np.ndarray:
    return np.unique(_shingle_hashes(text, shingle))


def set_fingerprints(docs: DataFrame, shingle: int, bits: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, raw, key (16 bytes that stand for the set of shingles), code, shingles for every row.

    Each different shingle counts once in the code, however often the text repeats it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, codes, counts = [], [], []
            for text in batch.column(2):
                found = _shingle_set(text.as_py(), shingle)
                keys.append(xxhash.xxh128_digest(found.tobytes()))
                codes.append(_majority(found, bits))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(codes, pa.binary()), pa.array(counts, pa.int64())],
                ["doc_id", "raw", "key", "code", "shingles"],
            )

    rows = docs.select(F.col(id).alias("doc_id"), raw_hash(text).alias("raw"), whole(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, raw long, key binary, code binary, shingles long")


def _sets(docs: DataFrame, nodes: DataFrame, shingle: int, id: str, text: str) -> DataFrame:
    """nodes (doc_id, raw and others) with held, the sorted hashes of their shingles; one row a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [_shingle_set(t, shingle).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(held, pa.binary())], [*batch.schema.names[:-1], "held"])

    of_node = nodes.withColumnsRenamed({"doc_id": "_id", "raw": "_raw"})
    others = [c for c in nodes.columns if c not in ("doc_id", "raw")]
    texts = docs.select(F.col(id).alias("_doc"), whole(text).alias("text"))
    told = same(F.col("_doc"), F.col("_id")) & (raw_hash() == F.col("_raw"))
    rows = texts.join(small_side(of_node), told).select(*others, "text")
    kinds = ", ".join(f"{c} {nodes.schema[c].dataType.simpleString()}" for c in others)
    return rows.mapInArrow(run, f"{kinds}, held binary").dropDuplicates(["node"])


def _matrix(codes: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), ">u8").astype(np.uint64).reshape(len(codes), -1)


def _count_steps(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of part counts within the radius, of each two opposite ones the one above zero."""
    steps = [((), 0)]
    for _ in range(parts):
        steps = [((*s, d), used + abs(d)) for s, used in steps for d in range(used - radius, radius - used + 1)]
    return [s for s, _ in steps if s > (0,) * parts]


def _with_count_tiles(nodes: DataFrame, parts: int, radius: int) -> DataFrame:
    """Adds home (the tile, its part counts in base 128) to nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = len(batch.column("code")[0].as_py()) if len(batch) else 8
            raw = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(batch), parts, wide // parts)
            counts = np.bitwise_count(raw).sum(axis=2, dtype=np.int64)
            home = counts @ (128 ** np.arange(parts - 1, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], [*batch.schema.names, "home"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{kinds}, home long")


def _forest(pairs: np.ndarray, bits: np.ndarray, size: int) -> np.ndarray:
    """Places of the pairs that make a minimum spanning forest: each tree takes its nearest outer pair, again and again."""
    tree, taken, order = np.arange(size), [], np.argsort(bits, kind="stable")
    live = order
    while len(live):
        a, b = tree[pairs[live, 0]], tree[pairs[live, 1]]
        live, a, b = live[a != b], a[a != b], b[a != b]
        if not len(live):
            break
        rank, best = np.arange(len(live)), np.full(size, len(live))
        np.minimum.at(best, a, rank)
        np.minimum.at(best, b, rank)
        chosen = np.unique(best[best < len(live)])
        taken.append(live[chosen])
        x, y = a[chosen], b[chosen]
        label = np.arange(size)
        while True:  # the least tree of those now joined
            low = np.minimum(label[x], label[y])
            new = label.copy()
            np.minimum.at(new, x, low)
            np.minimum.at(new, y, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        tree = label[tree]
    return np.concatenate(taken) if taken else np.empty(0, np.int64)


def _compare(radius: int):
    def run(table: pa.Table) -> pa.Table:
        held = table.column("held").combine_chunks()
        left = np.repeat(table.column("left").to_numpy(zero_copy_only=False), np.diff(held.offsets.to_numpy()))
        told_nodes, told_codes = held.flatten().flatten()
        node, codes = told_nodes.to_numpy(), _matrix(told_codes)
        a, b = np.flatnonzero(left), np.flatnonzero(~left)
        if not len(b):  # a block against itself comes once
            b = a
        strip, found, told = max(1, (1 << 19) // max(1, len(b))), [], []
        for low in range(0, len(a), strip):
            rows = a[low : low + strip]
            far = np.zeros((len(rows), len(b)), np.uint16)
            for word in range(codes.shape[1]):
                far += np.bitwise_count(codes[rows, word][:, None] ^ codes[b, word][None, :])
            i, j = np.nonzero(far <= radius)
            if a is b:
                i, j = i[low + i < j], j[low + i < j]
            found.append(np.stack([rows[i], b[j]], axis=1))
            told.append(far[i, j])
        pairs, bits = np.concatenate(found), np.concatenate(told)
        pairs = pairs[_forest(pairs, bits, len(node))]
        return pa.table({"u": node[pairs[:, 0]], "v": node[pairs[:, 1]]})

    return run


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Numbers of common members of each of the sets a with each of the sets b."""
    out = np.zeros((len(a), len(b)), np.int64)
    if len(a) + len(b) < DENSE_SETS:
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                out[i, j] = len(np.intersect1d(x, y, assume_unique=True))
        return out
    known = np.intersect1d(np.concatenate(a), np.concatenate(b))
    place = [[np.searchsorted(known, x[np.isin(x, known)]) for x in side] for side in (a, b)]
    for low in range(0, len(known), DENSE_SHINGLES):
        strips = []
        for side in place:
            strip = np.zeros((len(side), min(DENSE_SHINGLES, len(known) - low)), np.float32)
            for k, at in enumerate(side):
                strip[k, at[slice(*np.searchsorted(at, [low, low + DENSE_SHINGLES]))] - low] = 1
            strips.append(strip)
        out += (strips[0] @ strips[1].T).astype(np.int64)
    return out


def _similar(similarity: float):
    """Links of a spanning forest of the pairs of sets, one left and one not, of one group and as similar as asked.
    Without sets on the right the left ones are compared with each other."""
    share = Fraction(similarity).limit_denominator(10**6)

    def run(table: pa.Table) -> pa.Table:
        node, group = table.column("node").to_numpy(), table.column("group").to_numpy()
        left = table.column("left").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("held")]
        sizes, found, told = np.array([len(x) for x in sets]), [], []
        order = np.argsort(group, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            a, b = places[left[places]], places[~left[places]]
            alone = left.all()
            b = a if alone else b
            if not len(a) or not len(b):
                continue
            common = _overlaps([sets[k] for k in a], [sets[k] for k in b])
            union = sizes[a][:, None] + sizes[b][None, :] - common
            i, j = np.nonzero((common * share.denominator >= union * share.numerator) & (union > 0))
            if alone:
                i, j = i[i < j], j[i < j]
            found.append(np.stack([a[i], b[j]], axis=1))
            told.append(-common[i, j] / union[i, j])
        pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        pairs = pairs[_forest(pairs, np.concatenate(told) if told else np.empty(0), len(node))]
        return pa.table({"u": node[pairs[:, 0]], "v": node[pairs[:, 1]]})

    return run


def similar_links(sets: DataFrame, similarity: float) -> DataFrame:
    """Links u, v that keep all sets (node, group, shingles, held) connected that are of one group and as similar as asked.

    Groups that fit one block go together, many in one. Members of others are compared with
    pivots first. Those linked through pivots to most others, the core, are connected
    already, so the rest is compared with the core and with itself, block by block.
    """
    chunks = F.ceil(F.greatest(F.count(F.lit(1)) / SET_ROWS, F.sum("shingles") / SET_SHINGLES))
    sizes = materialise(sets.groupBy("group").agg(chunks.alias("chunks"), F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("all")), "groups")
    few = sizes.filter("chunks = 1")
    total = few.agg(F.sum("n"), F.sum("all")).first()
    buckets = max(math.ceil((total[0] or 0) / SET_ROWS), math.ceil((total[1] or 0) / SET_SHINGLES), 1)
    shape = "u long, v long"
    compare = lambda rows, *by: rows.groupBy(*by).applyInArrow(_similar(similarity), shape)
    of_few = sets.join(small_side(few.select("group")), "group").withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
    out = compare(of_few.withColumn("left", F.lit(True)), "bucket")
    large = sizes.filter("chunks > 1").select("group", "chunks")
    if large.isEmpty():
        return out
    placed = sets.join(small_side(large), "group").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    placed = materialise(placed.select("group", "chunks", "chunk", "node", "held"), "placed")
    numbers = placed.filter("chunk = 0").groupBy("group").agg(F.array_sort(F.collect_set("node")).alias("nodes"))
    chosen = numbers.select("group", F.explode(F.slice("nodes", 1, PIVOTS)).alias("node"))
    pivots = placed.join(F.broadcast(chosen) if chosen.count() <= PIVOTS * 1000 else chosen, ["group", "node"], "left_semi")
    pivots = pivots.withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1)")))
    both = pivots.select("group", "chunk", "node", "held", F.lit(True).alias("left")).unionByName(
        placed.select("group", "chunk", "node", "held", F.lit(False).alias("left"))
    )
    stars = materialise(compare(both, "group", "chunk"), "stars")
    placed = placed.join(small_side(components(stars)), "node", "left").withColumn("component", F.coalesce("component", "node"))
    cores = placed.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"))
    cores = cores.groupBy("group").agg(F.max_by("component", F.struct("n", "component")).alias("core"))
    placed = placed.join(small_side(cores), "group").withColumn("rest", F.col("component") != F.col("core"))
    placed = materialise(placed.select("group", "rest", "chunk", "node", "held"), "placed")
    homes = placed.select("group", "rest", "chunk").distinct()
    of_a = homes.filter("rest").select("group", F.col("chunk").alias("i"))
    of_b = homes.select("group", "rest", F.col("chunk").alias("j"))
    blocks = materialise(of_a.join(of_b, "group").filter("not rest or i <= j").withColumnRenamed("rest", "inner"), "blocks")
    own = F.col("inner") & (F.col("i") == F.col("j"))
    here = lambda at, left: placed.withColumnRenamed("chunk", at).join(
        small_side(blocks if left else blocks.filter(~own)), ["group", at]
    ).filter("rest" if left else "rest = inner").select("group", "inner", "i", "j", "node", "held", F.lit(left).alias("left"))
    rest = compare(here("i", True).unionByName(here("j", False)), "group", "inner", "i", "j")
    return out.unionByName(stars).unionByName(rest)


def links(nodes: DataFrame, meets: DataFrame, radius: int) -> DataFrame:
    """Links u, v among nodes (node, code, home) that keep all nodes within the radius connected.

    ``meets`` has the pairs of tiles (a, b) to be compared, a tile with itself included. A
    block travels as one row that holds its nodes.
    """
    sizes = nodes.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).alias("chunks"))
    sizes = materialise(sizes, "tiles")
    placed = nodes.join(small_side(sizes), "home").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    packed = placed.groupBy("home", "chunk").agg(F.collect_list(F.struct("node", "code")).alias("held"))
    packed = materialise(packed, "packed")
    of_a = sizes.select(F.col("home").alias("a"), F.col("chunks").alias("ca"))
    of_b = sizes.select(F.col("home").alias("b"), F.col("chunks").alias("cb"))
    blocks = (
        meets.join(of_a, "a")
        .join(of_b, "b")
        .withColumn("i", F.explode(F.expr("sequence(0L, ca - 1)")))
        .withColumn("j", F.explode(F.expr("sequence(0L, cb - 1)")))
        .filter("a <> b or i <= j")
        .select("a", "i", "b", "j")
    )
    blocks = materialise(blocks, "blocks")
    side = lambda tile, chunk, left: packed.join(
        small_side(blocks.filter("a <> b or i <> j") if not left else blocks),
        (F.col("home") == F.col(tile)) & (F.col("chunk") == F.col(chunk)),
    ).select("a", "i", "b", "j", F.lit(left).alias("left"), "held")
    both = side("a", "i", True).unionByName(side("b", "j", False))
    return both.groupBy("a", "i", "b", "j").applyInArrow(_compare(radius), "u long, v long")


def _numbered(docs: DataFrame) -> DataFrame:
    """A node for each different code, written so that its number holds."""
    rows = docs.select("code", "shingles").groupBy("code").agg(F.min("shingles").alias("shingles"))
    return materialise(rows.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _grouped(docs: DataFrame, nodes: DataFrame, edges: DataFrame, key: str = "code") -> DataFrame:
    """docs with component (a number) and component_id, the smallest doc_id of the component."""
    found = components(materialise(edges.distinct(), "links"))
    of_code = nodes.join(found, "node", "left").select(
        F.col(key).alias("_key"), F.coalesce("component", "node").alias("component")
    )
    of_code = materialise(of_code, "classes")
    told = docs.join(small_side(of_code), F.col(key) == F.col("_key")).drop("_key")
    least = materialise(told.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    return told.join(small_side(least), "component")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, raw, code, component_id for every row: 64-bit fingerprints linked within the radius."""
    rows = materialise(fingerprints(docs, shingle, 64, id, text), "simhash")
    nodes = _numbered(rows)
    count = nodes.count()
    parts = next((p for p, tiles in USUAL_TILES.items() if count <= tiles * TILE_ROWS * 2), 8)
    tiled = materialise(_with_count_tiles(nodes, parts, radius), "tiled")
    homes = tiled.select(F.col("home").alias("a")).distinct()
    moves = [sum(d * 128 ** (parts - 1 - k) for k, d in enumerate(s)) for s in _count_steps(parts, radius)]
    steps = F.array(*[F.lit(m).cast("long") for m in (0, *moves)])
    meets = homes.withColumn("b", F.explode(F.transform(steps, lambda m: F.col("a") + m)))
    return _grouped(rows, nodes, links(tiled, meets, radius)).select("doc_id", "raw", "code", "component_id")


def near_duplicates(
    docs: DataFrame,
    shingle: int = NEAR_WORDS,
    bits: int = NEAR_BITS,
    radius: int = NEAR_RADIUS,
    similarity: float = NEAR_SIMILARITY,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, raw, component_id, kept: one row of each group of near duplicates stays, that with the smallest id.

    Texts are linked where the Jaccard similarity of their sets of shingles is that asked or
    more. Wide fingerprints within the radius tell the candidates; sets as similar as asked
    differ in size by no more than that factor, so tiles are size classes of that ratio and
    only neighbouring classes meet. Sets are compared within the components of candidates.
    """
    rows = materialise(set_fingerprints(docs, shingle, bits, id, text), "simhash")
    nodes = rows.groupBy("key").agg(
        F.min("code").alias("code"), F.min("shingles").alias("shingles"), F.min(F.struct("doc_id", "raw")).alias("_of")
    )
    nodes = materialise(nodes.select("key", "code", "shingles", "_of.*").withColumn("node", F.monotonically_increasing_id()), "nodes")
    ratio = math.log(1 / similarity)
    home = F.floor(F.log(F.greatest(F.col("shingles"), F.lit(1))) / ratio).cast("long")
    tiled = materialise(nodes.select("node", "code", "shingles", home.alias("home")), "tiled")
    homes = tiled.select(F.col("home").alias("a")).distinct()
    meets = homes.withColumn("b", F.explode(F.array(F.col("a"), F.col("a") + 1)))
    near = components(materialise(links(tiled, meets, radius).distinct(), "links")).withColumnRenamed("component", "group")
    suspects = materialise(nodes.drop("key", "code").join(small_side(near), "node"), "suspects")
    sets = materialise(_sets(docs, suspects, shingle, id, text), "sets")
    told = _grouped(rows, nodes, similar_links(sets, similarity), "key")
    row = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("raw"))
    best = materialise(told.groupBy("component").agg(F.min(row).alias("best")), "best")
    best = best.select(F.col("component").alias("_component"), F.col("best.doc_id").alias("_id"), F.col("best.raw").alias("_raw"))
    told = told.join(small_side(best), F.col("component") == F.col("_component"))
    kept = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw"))
    return told.select("doc_id", "raw", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs, all columns, with one row of each group."""
    decided = near_duplicates(docs, id=id, text=text, **options)
    return keep(docs, decided.withColumnRenamed("doc_id", id), id, text)
