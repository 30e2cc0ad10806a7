"""Table sinks, exports, copies, and the catalogue folder.

Layout below a catalogue root, all Parquet:

    log/payloads/stream=S/batch=N    parsed payloads of one batch, good and bad
    log/done/stream=S/batch=N        one row, written when the batch is whole
    base/files/version=V             files that merge V added
    base/<child>/version=V           their child rows
    base/known/version=V             their ids, and the deliveries they came from
    base/audit/version=V             deliveries and times per file of merge V
    commits/version=V                the batches merge V covers, written last

A batch is one map-only write of its own folder: it reads nothing that grows with
the catalogue, and writing it again replaces it. Batches may be done in any order.
``merge_log`` folds the batches that are done and that no commit lists into the next
version, and writes no more than they bring; counts and times are summed up on reading.
Readers see a version once its commit exists, so a merge that dies half-way leaves no trace.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framecat.operators import ingest, upsert
from framecat.schemas import conform, table_schema
from framecat.session import materialise
from framecat.sources.payloads import parse_payloads

CHILDREN = ("parts", "channels", "attributes")
DELIVERY = ("stream", "batch", "delivery")
_KNOWN = "file_id string, stream string, batch bigint, delivery bigint"
_AUDIT = "file_id string, deliveries bigint, first_at string, last_at string, version bigint"
_BATCH = "stream string, batch bigint"
#: So many batches go into one version; a merge goes on until none is due.
MERGED_BATCHES = 10_000


def write_tables(rows: dict[str, DataFrame], root: str, mode: str = "append") -> None:
    """Write row sets to their tables with the declared schema; a first write makes the table."""
    for name, df in rows.items():
        conform(df, name).write.mode(mode).parquet(f"{root}/{name}")


def read_tables(spark: SparkSession, root: str, names: tuple[str, ...] = ("files", *CHILDREN)) -> dict[str, DataFrame]:
    return {n: spark.read.schema(table_schema(n)).parquet(f"{root}/{n}") for n in names}


_AUTO_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def write_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    keys: Sequence[str],
    buckets: int,
    widen: Callable[[DataFrame], DataFrame] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Stored as a table of so many buckets by the keys, one sorted file each; joins on the keys need no exchange.

    ``widen`` adds row by row what need not be shuffled. ``dealt`` says that the rows come, row by row,
    from a table with the same buckets, which is then read bucket by bucket instead of shuffled again.
    """
    spark, keys = df.sparkSession, list(keys)
    rows = df if dealt else df.repartition(buckets, *keys)
    rows = rows if widen is None else widen(rows)
    before = spark.conf.get(_AUTO_BUCKETS)
    if dealt:  # Spark reads a table by its buckets of itself only where a join or aggregate asks for it
        spark.conf.set(_AUTO_BUCKETS, "false")
    try:
        rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    finally:
        spark.conf.set(_AUTO_BUCKETS, before)
    return spark.table(table)


def write_partitioned(files: DataFrame, path: str, mtime: str = "mtime", mode: str = "overwrite") -> None:
    """Files by month of modification.

    Rebalancing gathers small months into few files and splits large ones over tasks.
    """
    month = F.substring(F.col(mtime).cast("string"), 1, 7)
    marked = files.withColumn("year_month", month).hint("rebalance", "year_month")
    marked.write.mode(mode).partitionBy("year_month").parquet(path)


def export_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write a copy and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clone_tables(tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    return {name: export_parquet(df, f"{root}/{name}") for name, df in tables.items()}


def same_contents(tables: dict[str, DataFrame], copies: dict[str, DataFrame]) -> DataFrame:
    """Row counts of each table and its copy, and whether all their rows are the same: table_name, rows, copied, same.

    Hashes of rows are added up, so rows that are lost, doubled or changed tell and order does not.
    """

    def told(name: str, df: DataFrame, copied: bool) -> DataFrame:
        row = F.xxhash64(*[F.col(c) for c in sorted(tables[name].columns)]).cast("decimal(38,0)")
        found = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("h"))
        return found.select(F.lit(name).alias("table_name"), F.lit(copied).alias("copied"), "n", "h")

    both = [told(n, df, False) for n, df in tables.items()] + [told(n, copies[n], True) for n in tables]
    pivoted = reduce(DataFrame.unionByName, both).groupBy("table_name").agg(
        F.max_by("n", ~F.col("copied")).alias("rows"),
        F.max_by("n", "copied").alias("copied_rows"),
        (F.count_distinct("n", "h") == 1).alias("same"),
    )
    return pivoted.select("table_name", "rows", F.col("copied_rows").alias("copied"), "same")


BUCKET_FILES = 4_000


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("file_id"), F.lit(buckets)).cast("int")


def write_buckets(files: DataFrame, path: str, buckets: int) -> None:
    """A files table in folders by hash of the file id, for ``upsert_buckets``."""
    files.withColumn("bucket", _bucket(buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def upsert_buckets(collapsed: DataFrame, path: str, schema: T.StructType, buckets: int) -> int:
    """Upsert a collapsed batch into ``write_buckets``; only buckets that the batch touches are read and written.

    Returns how many those are. A batch of fixed size touches as many buckets as it has files
    at most, whatever the catalogue's size. The folders are replaced by one job at its commit.
    """
    spark = collapsed.sparkSession
    batch = materialise(collapsed.withColumn("bucket", _bucket(buckets)), "batch")
    touched = [r.bucket for r in batch.select("bucket").distinct().collect()]  # numbers of buckets, no more than there are
    if not touched:
        return 0
    wide = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    existing = spark.read.schema(wide).parquet(path).filter(F.col("bucket").isin(touched)).drop("bucket")
    merged = upsert.upsert_files(existing, batch.drop("bucket")).withColumn("bucket", _bucket(buckets))
    # Written apart first: the folders to be replaced are those that are read.
    ready = materialise(merged, "merged")
    ready.repartition(min(len(touched), BUCKET_FILES), "bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("bucket").parquet(path)
    return len(touched)


def sample_copy(tables: dict[str, DataFrame], n: int = 100, key: str = "file_id") -> dict[str, DataFrame]:
    """The n files first in hash order, with their child rows."""
    files = tables["files"].orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
    ids = files.select(key)
    children = {c: df.join(ids, key, "left_semi") for c, df in tables.items() if c != "files"}
    return {"files": files, **children}


# The catalogue folder.


def _logged(lines: DataFrame, text: str, event: Column | None, at: Column | None, located: bool) -> DataFrame:
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    delivered = lines.select(
        F.col(text),
        (F.xxhash64(text) if event is None else event).cast("string").alias("event_id"),
        (now if at is None else at).alias("seen_at"),
    )
    told = ingest.with_errors(parse_payloads(delivered, text), located)
    return ingest.prepare(told).withColumn("delivery", F.monotonically_increasing_id())


def append_batch(
    lines: DataFrame,
    root: str,
    batch: int,
    stream: str = "batch",
    text: str = "value",
    event: Column | None = None,
    inspected_at: Column | None = None,
    located: bool = True,
) -> None:
    """Parse a batch of payload text once and log it, bad payloads with their error."""
    rows = _logged(lines, text, event, inspected_at, located)
    at = f"stream={stream}/batch={batch}"
    rows.write.mode("overwrite").parquet(f"{root}/log/payloads/{at}")
    done = lines.sparkSession.range(1).select(F.lit(True).alias("whole"))
    done.coalesce(1).write.mode("overwrite").parquet(f"{root}/log/done/{at}")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    nothing = spark.createDataFrame([], "value string")
    kinds = _logged(nothing, "value", None, None, True).schema
    schema = T.StructType([*kinds, T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())])
    return _read(spark, f"{root}/log/payloads", schema)


def read_errors(spark: SparkSession, root: str) -> DataFrame:
    """Logged payloads that were routed aside, with the reason."""
    bad = read_log(spark, root).filter(F.col("error").isNotNull())
    return bad.select("stream", "batch", "event_id", "seen_at", "error", ingest.RAW)


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table that may not exist yet."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _ddl(name: str, extra: str = "") -> str:
    body = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(name))
    return f"{body}{extra}"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    """The batches that each merge covers."""
    return _read(spark, f"{root}/commits", f"{_BATCH}, version bigint")


def _version(spark: SparkSession, root: str) -> int:
    return _commits(spark, root).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def read_catalogue(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four tables as of the last committed merge."""
    version = _version(spark, root)

    def table(name: str) -> DataFrame:
        rows = _read(spark, f"{root}/base/{name}", _ddl(name, ", version bigint"))
        return rows.filter(F.col("version") <= version).drop("version")

    audit = _read(spark, f"{root}/base/audit", _AUDIT).filter(F.col("version") <= version)
    audit = audit.groupBy("file_id").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("deliveries").alias("deliveries")
    )
    told = table("files").join(audit, "file_id").withColumns({
        "inspection_timestamp": F.col("first_at"),
        "inspection_count": F.col("deliveries").cast("int"),
        "last_inspected": F.col("last_at"),
    })
    return {"files": told.select(*table_schema("files").names), **{name: table(name) for name in CHILDREN}}


def merge_log(spark: SparkSession, root: str) -> int:
    """Fold done batches that no commit lists into next versions; returns the last version. Single writer."""
    version = _version(spark, root)
    while True:
        done = _read(spark, f"{root}/log/done", f"whole boolean, {_BATCH}").select("stream", "batch")
        due = done.join(_commits(spark, root), ["stream", "batch"], "left_anti").limit(MERGED_BATCHES)
        batches = [(r.stream, r.batch) for r in due.collect()]
        if not batches:
            return version
        version += 1
        _merge(spark, root, batches, version)


def _merge(spark: SparkSession, root: str, batches: list[tuple[str, int]], version: int) -> None:
    numbers: dict[str, list[int]] = {}
    for stream, batch in batches:
        numbers.setdefault(stream, []).append(batch)
    # Partition columns: only the folders of due batches are read.
    due = F.lit(False)
    for stream, own in numbers.items():
        due = due | ((F.col("stream") == stream) & F.col("batch").isin(own))
    log = read_log(spark, root).filter(due & F.col("error").isNull())

    def put(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{root}/base/{name}/version={version}")

    # Which deliveries bring a file not known yet: keys only, folded before the shuffle.
    known = _read(spark, f"{root}/base/known", f"{_KNOWN}, version bigint").filter(F.col("version") < version)
    order = F.struct("seen_at", "event_id", *DELIVERY)
    winners = log.groupBy("file_id").agg(F.min(order).alias("w")).select("file_id", "w.*")
    put(upsert.insert_children(known, winners).select("file_id", *DELIVERY), "known")
    new = _read(spark, f"{root}/base/known/version={version}", _KNOWN)
    # The winners' payloads, written once; every table takes its columns from there.
    fresh = materialise(log.join(new, ["file_id", *DELIVERY], "left_semi"), "fresh")
    put(conform(ingest.files_rows(fresh, inspected_at=F.col("seen_at")), "files"), "files")
    for name in CHILDREN:
        put(conform(ingest.FAN_OUT[name](fresh), name), name)
    audit = log.groupBy("file_id").agg(
        F.count("*").alias("deliveries"), F.min("seen_at").alias("first_at"), F.max("seen_at").alias("last_at")
    )
    put(audit, "audit")
    spark.createDataFrame(batches, _BATCH).coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/version={version}")
