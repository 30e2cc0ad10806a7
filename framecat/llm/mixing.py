"""Mixing sources to target weights by a low-discrepancy schedule.

Sources, in code point order and null last, weigh 5, 2, 1, 5, ... and share the words of all
documents; a target stops at three times its source's words, and the excess is shared again
by weight. Each source's documents, in a seeded hash order, make one stream of words that
starts over when it ends; the stream is cut into blocks of equal length. Slots of the mix are
golden-ratio points: slot i lies at the fractional part of i times the golden ratio, and
belongs to the source whose part of the cumulative weights holds that point. The k-th slot of
a source takes its k-th block. A source gets exactly as many slots as its target fills: of
what the points give it too many are dropped, and what they give too few (a few, as the
points are that even) stand at the end.

Ranks and running totals are sums per chunk first, so that a source with a third of all rows
is worked on in many tasks. The weights and targets of sources stay in a table; the level of
the shared words is found by a few sums over it.

Defined results: a null text has no words; rows without words are never taken; a null source
is a source; rows that repeat are separate rows; without any words all targets are zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.llm.common import fresh, numbered, raw_hash, running_total, same, small_side, whole, words_of
from framecat.session import materialise

BLOCK_WORDS = 2048
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
CHUNK_BITS = 15
#: Points are whole numbers below 2**36; the step is that part of the golden ratio, odd.
POINT_BITS = 36
GOLDEN_STEP = 42_470_972_311
BINS = 1 << 12


def _rows(docs: DataFrame, id: str, text: str, source: str, seed: int) -> DataFrame:
    """Size and place in the hash order of every row; written, so that row numbers hold."""
    rows = docs.select(
        F.col(id).alias("doc_id"),
        raw_hash(text).alias("raw"),
        F.col(source).cast("string").alias("source"),
        F.size(words_of(whole(text))).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    return materialise(rows.withColumn("shuffled", F.xxhash64(F.lit(seed), "doc_id", "raw")), "sizes")


def _level(sources: DataFrame) -> float:
    """Words per unit of weight of the sources that do not reach their limit."""
    limit, count = MAX_REPEATS * F.col("source_size"), -1
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (total or 0) / (weights or 1)
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        n, words, weight = sources.agg(
            F.count_if(full), F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if n == count or not weight:
            return level
        count, level = n, (total - words) / weight


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, place, weight, target, quota (the target in whole words) for every source."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = numbered(sources, [F.col("source").isNull(), F.col("source")], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    placed = materialise(placed.withColumn("weight", weight), "sources")
    share = F.lit(_level(placed)) * F.col("weight")
    target = F.least(share, (MAX_REPEATS * F.col("source_size")).cast("double"))
    return placed.withColumn("target", target).withColumn("quota", F.round("target").cast("long"))


def _points(slots: Column) -> Column:
    """slot times the step, modulo 2**POINT_BITS, without overflow."""
    half, low = POINT_BITS - 12, (1 << (POINT_BITS - 12)) - 1
    mask = F.lit((1 << POINT_BITS) - 1)
    upper = (F.shiftright(slots, half) * GOLDEN_STEP).bitwiseAND(mask).bitwiseAND(F.lit((1 << 12) - 1))
    lower = slots.bitwiseAND(F.lit(low)) * GOLDEN_STEP
    return (lower + F.shiftleft(upper, half)).bitwiseAND(mask)


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """slot, place, block for each block of each source: which source stands where, and its how-manieth block."""
    spark = sources.sparkSession
    needed = sources.select("place", F.ceil(F.col("quota") / block).cast("long").alias("needed")).filter("needed > 0")
    total = needed.agg(F.sum("needed")).first()[0] or 0
    scale = F.lit((1 << POINT_BITS) / max(1, total))
    spans = running_total(
        needed.withColumn("_all", F.lit(0)).withColumn("_of", F.shiftright("place", CHUNK_BITS)), "_all", "_of", ["place"], "needed", "before"
    )
    spans = spans.select(
        "place",
        "needed",
        F.floor(F.col("before") * scale).cast("long").alias("low"),
        F.floor((F.col("before") + F.col("needed")) * scale).cast("long").alias("high"),
    )
    width = POINT_BITS - 12
    bins = spans.withColumn("bin", F.explode(F.sequence(F.shiftright("low", width), F.shiftright(F.greatest("low", F.col("high") - 1), width))))
    points = spark.range(total).select(F.col("id").alias("slot"), _points(F.col("id")).alias("point"))
    points = points.withColumn("bin", F.shiftright("point", width))
    hit = points.join(small_side(materialise(bins, "bins")), "bin").filter("low <= point and point < high")
    hit = hit.select("slot", "place", F.lit(1).cast("long").alias("one"), F.shiftright("slot", CHUNK_BITS).alias("part"))
    ranked = running_total(hit, "place", "part", ["slot"], "one", "block").select("slot", "place", "block")
    spans = materialise(spans, "spans")
    taken = materialise(ranked.join(small_side(spans.select("place", "needed")), "place").filter("block < needed").drop("needed"), "slots")
    counts = taken.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    short = spans.join(counts, "place", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n < needed")
    late = short.select("place", F.explode(F.expr("sequence(n, needed - 1)")).alias("block"))
    late = late.select((F.lit(total) + F.col("block")).alias("slot"), "place", "block")
    return taken.unionByName(late)


def _pieces(rows: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """row, place, epoch, block, from_word, words: the documents cut along the blocks of their source's stream."""
    count = rows.count()
    bits = max(0, (count >> CHUNK_BITS).bit_length())
    chunk = F.shiftrightunsigned("shuffled", 64 - bits) if bits else F.lit(0).cast("long")
    held = sources.select(F.col("source").alias("_source"), "place", "source_size", "quota").filter("quota > 0")
    placed = rows.filter("size > 0").join(small_side(held), same(F.col("source"), F.col("_source"))).withColumn("chunk", chunk)
    placed = running_total(placed, "place", "chunk", ["shuffled", "doc_id", "raw", "row"], "size", "begin")
    turns = placed.withColumn("epoch", F.explode(F.expr(f"sequence(0L, {MAX_REPEATS - 1}L)")))
    turns = turns.withColumn("first", F.col("epoch") * F.col("source_size") + F.col("begin"))
    turns = turns.withColumn("last", F.least(F.col("first") + F.col("size"), F.col("quota"))).filter("first < last")
    cut = turns.withColumn("block", F.explode(F.expr(f"sequence(first div {block}, (last - 1) div {block})")))
    start, end = F.greatest("first", F.col("block") * block), F.least("last", (F.col("block") + 1) * block)
    return cut.select("row", "doc_id", "raw", "size", "place", "epoch", "block", (start - F.col("first")).alias("from_word"), (end - start).alias("words"))


def mixture(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = 42, id: str = "doc_id", text: str = "text", source: str = "source"):
    """The rows with sizes, the sources with targets, and the mix: slot, row, doc_id, raw, size, epoch, from_word, words."""
    rows = _rows(docs, id, text, source, seed)
    sources = materialise(targets(rows), "targets")
    pieces = _pieces(rows, sources, block)
    mix = pieces.join(schedule(sources, block), ["place", "block"])
    return rows, sources, materialise(mix.drop("place", "block"), "mix")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    rows, sources, mix = mixture(docs, **options)
    taken = materialise(mix.groupBy("row").agg(F.sum("words").alias("taken")), "taken").withColumnRenamed("row", "_row")
    told = rows.join(small_side(taken), F.col("row") == F.col("_row"), "left")
    held = sources.select(F.col("source").alias("_source"), "source_size", "target")
    told = told.join(small_side(held), same(F.col("source"), F.col("_source")))
    return told.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", slot: str | None = None, **options) -> DataFrame:
    """The mix as rows of docs, all columns: a document once for each time its source comes round to it.

    With a name for it, a further column has the slot of the first of the document's blocks: rows
    sorted by it come in the order of the schedule.

    Its text is whole but where the source's target ends inside it (one document a source);
    there the words taken stand joined by blanks, and n_chars, if docs has it, is theirs.
    """
    rows, _, mix = mixture(docs, id=id, text=text, **options)
    id_, raw_, size_, from_, words_, slot_ = fresh(docs, "_id", "_raw", "_size", "_from", "_words", "_slot")
    plan = mix.groupBy("row", "epoch").agg(
        F.first("doc_id").alias(id_),
        F.first("raw").alias(raw_),
        F.first("size").alias(size_),
        F.min("from_word").alias(from_),
        F.sum("words").alias(words_),
        F.min("slot").alias(slot_),
    )
    plan = materialise(plan.drop("row", "epoch"), "plan")
    if not rows.groupBy("doc_id", "raw").count().filter("count > 1").isEmpty():
        docs = docs.withColumn(raw_, raw_hash(text)).dropDuplicates([id, raw_]).drop(raw_)
    told = docs.join(small_side(plan), docs[id].eqNullSafe(F.col(id_)) & (raw_hash(text) == F.col(raw_)))
    part = F.array_join(F.slice(words_of(whole(text)), (F.col(from_) + 1).cast("int"), F.col(words_).cast("int")), " ")
    told = told.withColumn(text, F.when(F.col(words_) == F.col(size_), F.col(text)).otherwise(part))
    if "n_chars" in docs.columns:
        kept = F.when(F.col(words_) == F.col(size_), F.col("n_chars"))
        told = told.withColumn("n_chars", kept.otherwise(F.char_length(text)).cast(docs.schema["n_chars"].dataType))
    order = [F.col(slot_).alias(slot)] if slot else []
    return told.select(*docs.columns, *order)
