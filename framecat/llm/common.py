"""What the operators share: words, row identities, checked broadcasts, running totals."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framecat.session import materialise

#: White space is these six characters everywhere; a word is a run of others.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: A side of at most so many narrow rows (two or three numbers each) may be broadcast.
BROADCAST_ROWS = 400_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: Column | str) -> Column:
    """The text, or the empty text for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def without_white(text: Column) -> Column:
    """The text without its white space; one replacement per character, which is faster than a pattern."""
    for white in WHITE:
        text = F.replace(text, F.lit(white), F.lit(""))
    return text


def spaced(text: Column) -> Column:
    """The text with a blank for each white space character."""
    for white in WHITE[1:]:
        text = F.replace(text, F.lit(white), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """Its words; a split at one plain character needs no pattern."""
    return F.array_remove(F.split(spaced(text), " "), "")


def raw_hash(text: str = "text") -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(whole(text))


def small_side(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a side for broadcasting if its counted rows fit; else Spark shuffles both sides."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores at its end as docs needs to have no column of that name."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def keep(docs: DataFrame, decided: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that a decision keeps, with all their columns.

    decided has ``id``, ``raw`` (raw_hash of the text) and ``kept``, one row per document.
    The rows to go are usually the fewer, so they are the side that may be broadcast;
    texts are shuffled only where that side is too large. If rows repeat with id and text
    and one of them stays, the others go.
    """
    id_, raw_ = fresh(docs, "_id", "_raw")
    per = decided.groupBy(F.col(id).alias(id_), F.col("raw").alias(raw_)).agg(
        F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_n"), F.sum(F.col("kept").cast("long")).alias("_stay")
    )
    per = materialise(per.filter(~F.col("_kept") | (F.col("_n") > F.col("_stay"))), "decided")
    gone = per.filter(~F.col("_kept")).select(id_, raw_)
    twice = per.filter("_kept").select(id_, raw_)
    told = (docs[id].eqNullSafe(F.col(id_))) & (raw_hash(text) == F.col(raw_))
    if twice.isEmpty():
        return docs.join(small_side(gone), told, "left_anti")
    once = docs.join(small_side(twice), told, "left_semi").withColumn(raw_, raw_hash(text))
    once = once.dropDuplicates([id, raw_]).drop(raw_)
    both = per.select(id_, raw_)
    return docs.join(small_side(both), told, "left_anti").unionByName(once)


def sent(spark: SparkSession, value):
    """A broadcast of a value of bounded size, with its class, so that workers need not have this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def numbered(rows: DataFrame, order: list[Column], into: str) -> DataFrame:
    """Numbers rows from zero in a total order without one task that sees them all; written, so numbers hold."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(
        placed.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "numbered"
    )
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the shuffle, whatever the number of rows.
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("_part", before.alias("_before"))
    inside = F.col("_at").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(starts), "_part").withColumn(into, F.col("_before") + inside).drop("_part", "_at", "_before")


def running_total(rows: DataFrame, key: str, chunk: str, order: list[str], amount: str, into: str) -> DataFrame:
    """Adds the sum of ``amount`` over the rows before this one within its key.

    Rows are summed per (key, chunk) first, and only those sums are gathered per key, so
    a key with a third of all rows is worked on in as many tasks as it has chunks. Chunks
    must follow the order.
    """
    sums = rows.groupBy(key, chunk).agg(F.sum(amount).alias("_sum"))
    earlier = W.partitionBy(key).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(
        F.col(key).alias("_key"), F.col(chunk).alias("_chunk"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start")
    )
    inside = W.partitionBy(key, chunk).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = placed.join(starts, same(F.col(key), F.col("_key")) & (F.col(chunk) == F.col("_chunk")))
    return joined.withColumn(into, F.col("_start") + F.col("_inside")).drop("_key", "_chunk", "_start", "_inside")
