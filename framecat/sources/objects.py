"""Objects in a store: listing, and bounded reads of their first bytes.

``scan`` does both in the tasks: a data source whose partitions are prefixes of the store, so
the driver holds prefixes and never an index of all objects. ``list_objects`` is Spark's own
listing, which does; ``header_scan`` reads the objects of any listing.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

# What runs inside tasks travels with them, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER_BYTES = 256 * 1024
OBJECTS_PER_TASK = 2_000
READS_AT_ONCE = 8

Decode = Callable[[bytes], dict]


def list_objects(spark: SparkSession, path: str, suffix: str | None = None, recursive: bool = True) -> DataFrame:
    """path, length and modificationTime of each object; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{_either_case(suffix)}")
    return reader.load(path).select("path", "length", "modificationTime")


def _either_case(text: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


def store_and_name(path: str) -> tuple[str, str]:
    """The root of a listed path's store as Arrow spells it ("" is local), and the object's name there, as it is."""
    scheme, mark, rest = path.partition(":")
    if not mark or scheme == "file":
        return "", "/" + (rest if mark else path).lstrip("/")
    if scheme == "dbfs":
        return "", "/dbfs/" + rest.lstrip("/")
    rest = rest.lstrip("/")
    if scheme in ("s3", "s3a", "s3n", "gs"):
        return f"{'gs' if scheme == 'gs' else 's3'}://{rest.partition('/')[0]}", rest
    host, _, name = rest.partition("/")
    return f"{scheme}://{host}/", "/" + name


def put_objects(rows: DataFrame, path: str) -> int:
    """Write each ``key`` of the rows (key, text) as an object below a path; returns how many.

    Tasks write objects themselves, each under its final name: a commit that moves every object
    is work of the driver that grows with their number. Texts of one key go into one object.
    A task that is run again writes the same objects again.
    """
    spread = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / OBJECTS_PER_TASK))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, folders = _clients(), set()

        def write(item: tuple[str, bytes]) -> None:
            root, name = store_and_name(f"{path}/{item[0]}")
            with client(root).open_output_stream(name) as f:
                f.write(item[1])

        def whole() -> Iterator[tuple[str, bytes]]:
            at, texts = None, []
            for batch in batches:
                for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                    if key != at:
                        if texts:
                            yield at, b"".join(texts)
                        at, texts = key, []
                    texts.append(text.encode())
            if texts:
                yield at, b"".join(texts)

        count = 0
        with ThreadPoolExecutor(READS_AT_ONCE) as pool:
            items = whole()
            while some := list(islice(items, 64)):
                for folder in {f"{path}/{key}".rpartition("/")[0] for key, _ in some} - folders:
                    root, name = store_and_name(folder)
                    client(root).create_dir(name, recursive=True)
                    folders.add(folder)
                list(pool.map(write, some))
                count += len(some)
        yield pa.RecordBatch.from_pydict({"n": [count]})

    dealt = rows.select("key", "text").repartition(spread, "key").sortWithinPartitions("key", "text")
    return dealt.mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def header_scan(
    objects: DataFrame,
    decode: Decode,
    decoded: str,
    n: int = HEADER_BYTES,
    partitions: int | None = None,
) -> DataFrame:
    """Read the first ``n`` bytes of each object and decode them.

    ``decode`` maps bytes to a dict with the fields of the DDL ``decoded``. What
    goes wrong with one object is told in its ``error`` column, not raised. Paths
    are spread over tasks first, since listings come in few partitions and each
    path costs a round trip; a task has one client per store and reads some
    objects at once.
    """
    fields = T.StructType.fromDDL(decoded)
    schema = T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("length", T.LongType())]
        + list(fields)
        + [T.StructField("error", T.StringType())]
    )
    names = fields.names

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = _clients()
        with ThreadPoolExecutor(READS_AT_ONCE) as pool:
            for batch in batches:
                told = pool.map(lambda p: _head(client, decode, names, p, n), batch["path"])
                rows = [{"path": p, "length": n_, **x} for p, n_, x in zip(batch["path"], batch["length"], told)]
                yield pd.DataFrame(rows, columns=schema.names, dtype=object)

    thin = objects.select("path", "length")
    spread = partitions or max(
        objects.sparkSession.sparkContext.defaultParallelism, math.ceil(thin.count() / OBJECTS_PER_TASK)
    )
    return thin.repartition(spread).mapInPandas(scan, schema)


def _head(client, decode: Decode | None, names: list[str], path: str, n: int) -> dict:
    """What the first bytes of one object tell, or what went wrong."""
    empty = dict.fromkeys(names)
    if decode is None:
        return {**empty, "error": None}
    try:
        root, name = store_and_name(path)
        with client(root).open_input_file(name) as f:
            found = decode(f.read(n))
        return {**{k: found.get(k) for k in names}, "error": None}
    except Exception as exc:  # noqa: BLE001 - becomes an error row
        return {**empty, "error": f"{type(exc).__name__}: {exc}"}


def _clients():
    from pyarrow import fs

    held: dict[str, fs.FileSystem] = {}

    def client(root: str):
        if root not in held:
            held[root] = fs.FileSystem.from_uri(root)[0] if root else fs.LocalFileSystem()
        return held[root]

    return client


def _listed(client, path: str, recursive: bool) -> tuple[list, list]:
    """Files and folders below a path, spelled as the path is."""
    from pyarrow import fs

    root, name = store_and_name(path)
    found = client(root).get_file_info(fs.FileSelector(name, recursive=recursive))
    base = path.rstrip("/")
    spelled = [(base + i.path[len(name.rstrip("/")) :], i) for i in found]
    return [x for x in spelled if x[1].type == fs.FileType.File], [x for x in spelled if x[1].type == fs.FileType.Directory]


@dataclass
class Prefix(InputPartition):
    """Part of a store that one task lists: all below a path, or what lies in it directly."""

    path: str
    recursive: bool

    def __post_init__(self) -> None:
        super().__init__((self.path, self.recursive))


class PrefixReader(DataSourceReader):
    """Lists prefixes in tasks and reads the first bytes of what it finds."""

    def __init__(self, schema: T.StructType, options: dict[str, str], decode: Decode | None):
        self.names = [f.name for f in schema][3:-1]
        self.schema, self.decode = schema, decode
        self.path, self.suffix = options["path"].rstrip("/"), options.get("suffix", "").lower()
        self.depth, self.n = int(options.get("depth", "1")), int(options.get("n", str(HEADER_BYTES)))
        self.shortest, self.longest = 0, 2**63 - 1

    def partitions(self) -> list[Prefix]:
        client, level, out = _clients(), [self.path], []
        for _ in range(self.depth):
            below = []
            for path in level:
                files, folders = _listed(client, path, False)
                below += [p for p, _ in folders]
                if files:
                    out.append(Prefix(path, False))
            level = below
        return out + [Prefix(path, True) for path in level]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        client = _clients()
        files, _ = _listed(client, partition.path, partition.recursive)
        told = [(p, i) for p, i in files if p.lower().endswith(self.suffix) and self.shortest <= i.size <= self.longest]
        shape = to_arrow_schema(self.schema)
        with ThreadPoolExecutor(READS_AT_ONCE) as pool:
            for at in range(0, len(told), OBJECTS_PER_TASK):
                part = told[at : at + OBJECTS_PER_TASK]
                heads = pool.map(lambda x: _head(client, self.decode, self.names, x[0], self.n), part)
                rows = [{"path": p, "length": i.size, "modificationTime": i.mtime, **h} for (p, i), h in zip(part, heads)]
                yield pa.RecordBatch.from_pylist(rows, schema=shape)


class BoundedReader(PrefixReader):
    """The same where the session lets filters reach Python sources."""

    def pushFilters(self, filters):
        """Bounds of the length: objects outside are not opened."""
        for f in filters:
            if getattr(f, "attribute", None) != ("length",):
                yield f
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.shortest = max(self.shortest, f.value + isinstance(f, GreaterThan))
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.longest = min(self.longest, f.value - isinstance(f, LessThan))
            else:
                yield f


def scan(
    spark: SparkSession,
    path: str,
    decode: Decode | None = None,
    decoded: str = "",
    n: int = HEADER_BYTES,
    suffix: str = "",
    depth: int = 1,
) -> DataFrame:
    """path, length, modificationTime, the fields of ``decoded`` and error for each object below a path.

    Folders ``depth`` levels down are the prefixes; one task lists each and, with a ``decode``,
    reads the first ``n`` bytes of its objects. Filters on ``length`` reach the source (with
    spark.sql.python.filterPushdown.enabled), so that what they exclude is not opened.
    """
    fields = f"path string, length bigint, modificationTime timestamp, {decoded}{', ' if decoded else ''}error string"
    name = f"objects_{uuid.uuid4().hex}"
    kind = BoundedReader if spark.conf.get("spark.sql.python.filterPushdown.enabled") == "true" else PrefixReader

    class Objects(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return fields

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return kind(schema, self.options, decode)

    spark.dataSource.register(Objects)
    return spark.read.format(name).option("suffix", suffix).option("n", n).option("depth", depth).load(path)
