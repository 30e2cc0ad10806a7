"""From payloads to table rows, and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framecat.functions import arrow_vectors, keys, structure, values, vectors
from framecat.schemas import CORRUPT, FINGERPRINT_DIM, METADATA_DIM
from framecat.sources.payloads import RAW, parse_payloads

# Why a payload is routed aside.
MALFORMED = "Malformed payload"
NO_LOCATION = "Missing bucket/key"
BAD_SUFFIX = "Unsupported file extension"
NO_PATH = "Payload missing file.path"
NULL_ARRAY = "Null parts, channels or attributes"


def with_errors(parsed: DataFrame, located: bool = True) -> DataFrame:
    """Add ``error``: NULL, or the first thing wrong with the payload."""
    # Payloads are parsed before anything is asked of them, not again for each condition.
    parsed = parsed.withColumn("payload", arrow_vectors.settled(F.col("payload")))
    file = F.col("payload.file")

    def blank(c: Column) -> Column:
        return F.coalesce(c, F.lit("")) == ""

    def explicit_null(field: str) -> Column:
        """Absent is fine, null is not; only rows without the field are parsed again."""
        at = F.try_variant_get(F.try_parse_json(F.col(RAW)), f"$.{field}", "variant")
        lost = F.col(f"payload.{field}").isNull()
        if field == "attributes":  # held as VARIANT, where null is a value
            return F.coalesce(F.is_variant_null(F.col("payload.attributes")), F.lit(False))
        return F.when(lost, F.coalesce(F.is_variant_null(at), F.lit(False))).otherwise(False)

    message = F.when(
        F.col("payload").isNull() | F.col(f"payload.{CORRUPT}").isNotNull(), MALFORMED
    )
    key = F.col("payload.file.s3_key")
    if located:
        message = message.when(blank(F.col("payload.file.s3_bucket")) | blank(key), NO_LOCATION)
        message = message.when(~keys.has_suffix(key), BAD_SUFFIX)
    message = message.when(file.isNull() | blank(F.col("payload.file.path")), NO_PATH)
    nulls = [explicit_null(f) for f in ("parts", "channels", "attributes")]
    message = message.when(nulls[0] | nulls[1] | nulls[2], NULL_ARRAY)
    return parsed.withColumn("error", message)


def route_errors(parsed: DataFrame, located: bool = True) -> tuple[DataFrame, DataFrame]:
    """Good payloads, and bad ones with a message. Every row is in exactly one."""
    told = with_errors(parsed, located)
    return told.filter(F.col("error").isNull()).drop("error"), told.filter(F.col("error").isNotNull())


def prepare(good: DataFrame) -> DataFrame:
    """Fill in defaults and derive identity and structure, once for all four tables."""

    def array(name: str, fill) -> Column:
        items = F.filter(F.col(f"payload.{name}"), lambda x: x.isNotNull())
        return arrow_vectors.settled(F.coalesce(F.transform(items, fill), F.array()))

    file = "payload.file."
    blank = F.lit("")
    filled = good.select(
        *[c for c in good.columns if c != "payload"],
        F.col(file + "path").alias("file_path"),
        F.coalesce(file + "mtime", blank).alias("mtime"),
        F.col("payload.file").alias("file"),
        array("parts", structure.filled_part).alias("parts"),
        array("channels", structure.filled_channel).alias("channels"),
        F.col("payload.attributes").alias("attributes"),
    )
    return filled.select(
        "*",
        keys.file_id(F.col("file_path"), F.col("mtime")).alias("file_id"),
        structure.payload_structure(F.col).alias("structure"),
    )


def files_rows(prepared: DataFrame, inspected_at: Column | None = None, dim: int = METADATA_DIM, tail_weight: float = 1.0) -> DataFrame:
    """One row per payload, which holds the whole header of a file."""
    now = keys.iso_utc(F.current_timestamp()) if inspected_at is None else inspected_at
    count = F.coalesce("file.multipart_count", F.lit(0))
    deep = F.coalesce("file.is_deep", F.lit(False))
    # The file's own flag is what the vector sees, as the parts' flags may be absent.
    flagged = F.col("structure").withField("is_deep", deep)
    hashed = structure.header_hash(count, deep, F.col("structure.header_digest"))
    ready = prepared.withColumn("header_hash", hashed).withColumn("shape", arrow_vectors.settled(flagged))
    return ready.select(
        "file_id",
        "file_path",
        keys.normalize_path(F.col("file_path")).alias("file_path_normalized"),
        "header_hash",
        F.coalesce("file.size_bytes", F.lit(0)).alias("size_bytes"),
        "mtime",
        count.alias("multipart_count"),
        deep.alias("is_deep"),
        arrow_vectors.metadata_embedding(F.col("shape"), dim, tail_weight).alias("metadata_embedding"),
        F.col("file.frame_number").alias("frame_number"),
        now.alias("inspection_timestamp"),
        F.lit(1).alias("inspection_count"),
        now.alias("last_inspected"),
        F.col("file.s3_bucket").alias("s3_bucket"),
        keys.content_id(
            F.col("file.s3_bucket"),
            F.coalesce("file.s3_key", "file_path"),
            F.col("mtime"),
            F.col("header_hash"),
        ).alias("content_id"),
        RAW,
    )


def payload_vectors(lines: DataFrame, dim: int = METADATA_DIM, tail_weight: float = 1.0) -> DataFrame:
    """``metadata_embedding`` of payload text (column ``value``), for looking up files like it; bad payloads give no row."""
    good, _ = route_errors(parse_payloads(lines), located=False)
    flagged = F.col("structure").withField("is_deep", F.coalesce("file.is_deep", F.lit(False)))
    ready = prepare(good).select(arrow_vectors.settled(flagged).alias("shape"))
    return ready.select(arrow_vectors.metadata_embedding(F.col("shape"), dim, tail_weight).alias("metadata_embedding"))


def parts_rows(prepared: DataFrame) -> DataFrame:
    """One row per part; files without parts give none."""
    return prepared.select("file_id", "file_path", F.inline("parts"))


def channels_rows(prepared: DataFrame, dim: int = FINGERPRINT_DIM) -> DataFrame:
    """One row per channel; the fingerprint stands on a payload's first row, zeros elsewhere."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    marked = prepared.select(
        "file_id",
        "file_path",
        "channels",
        vectors.channel_fingerprint(F.col("channels"), dim).cast("array<float>").alias("fingerprint"),
    )
    kept = ["file_id", "file_path"]
    rows = marked.select(*kept, "fingerprint", F.posexplode("channels").alias("pos", "c"))
    return rows.select(
        *kept,
        F.col("c.part_index").alias("part_index"),
        F.col("c.name").alias("channel_name"),
        F.col("c.layer_name").alias("layer_name"),
        F.col("c.component_name").alias("component_name"),
        F.col("c.type").alias("channel_type"),
        F.col("c.x_sampling").alias("x_sampling"),
        F.col("c.y_sampling").alias("y_sampling"),
        F.when(F.col("pos") == 0, F.col("fingerprint")).otherwise(zeros).alias("channel_fingerprint"),
    )


def attributes_rows(prepared: DataFrame) -> DataFrame:
    """One row per attribute; the outer position is the part, entries that are no list are skipped."""
    lists = F.try_variant_get(F.col("attributes"), "$.parts", "array<variant>")
    kept = ["file_id", "file_path"]
    outer = prepared.select(*kept, F.posexplode(lists).alias("pos", "of_part"))
    inner = outer.select(
        *kept,
        F.col("pos").alias("part_index"),
        F.explode(F.try_variant_get(F.col("of_part"), "$", "array<variant>")).alias("a"),
    )

    def text(field: str) -> Column:
        return F.coalesce(F.try_variant_get(F.col("a"), f"$.{field}", "string"), F.lit(""))

    typed = inner.select(
        *kept,
        "part_index",
        text("name").alias("attr_name"),
        text("type").alias("attr_type"),
        F.try_variant_get(F.col("a"), "$.value", "variant").alias("value"),
    )
    shadows = values.attribute_values(F.col("value"))
    return typed.select(
        *[c for c in typed.columns if c != "value"], *[c.alias(n) for n, c in shadows.items()]
    )


FAN_OUT = {
    "files": files_rows,
    "parts": parts_rows,
    "channels": channels_rows,
    "attributes": attributes_rows,
}


def build_payload(
    files: DataFrame,
    parts: DataFrame,
    channels: DataFrame,
    attributes: DataFrame,
    key: str = "file_key",
) -> DataFrame:
    """Table rows back to payload text, as ``key`` and ``value``: one payload per file.

    A payload is one JSON text, so a header's rows meet in one row; a header is what
    the first bytes of an image file hold, which bounds it. Parts and attributes become
    JSON text row by row before they meet; rows are shuffled once.
    """
    windows = ("data_window", "display_window")

    def shown(name: str) -> Column:
        value = F.col(name)
        return F.when(value != 0, value).alias(name) if name in ("tile_width", "tile_height", "tile_depth") else value

    plain = F.to_json(F.struct(*[shown(n) for n in structure.PART_COLUMNS if n not in windows]))
    fields = F.nullif(F.substr(plain, F.lit(2), F.length(plain) - 2), F.lit(""))
    # Texts of JSON values are taken over as they are.
    taken = [F.when(F.col(n) != "null", F.concat(F.lit(f'"{n}":'), F.col(n))) for n in windows]
    part = F.struct(
        "part_index",
        F.concat(F.lit("{"), F.concat_ws(",", fields, *taken), F.lit("}")).alias("text"),
        F.coalesce("is_deep", F.lit(False)).alias("is_deep"),
    )
    channel = F.struct(
        "part_index",
        F.col("channel_name").alias("name"),
        "layer_name",
        "component_name",
        F.col("channel_type").alias("type"),
        "x_sampling",
        "y_sampling",
    )
    named = F.to_json(F.struct(F.col("attr_name").alias("name"), F.col("attr_type").alias("type")))
    text = F.concat(F.substr(named, F.lit(1), F.length(named) - 1), F.lit(',"value":'), F.col("value_json"), F.lit("}"))
    attribute = F.struct("part_index", F.col("attr_name").alias("name"), F.col("attr_type").alias("type"), "value_json", text.alias("text"))
    header = F.struct(
        F.col("s3_key").alias("path"),
        "s3_key",
        "s3_bucket",
        "size_bytes",
        "mtime",
        keys.frame_number(F.col("s3_key")).alias("frame_number"),
    )
    tagged = [
        files.select(key, header.alias("header")),
        parts.select(key, part.alias("part")),
        channels.select(key, channel.alias("channel")),
        attributes.select(key, attribute.alias("attribute")),
    ]
    grouped = (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
        .groupBy(key)
        .agg(
            F.any_value("header", True).alias("header"),
            F.array_sort(F.collect_list("part")).alias("parts"),
            F.array_sort(F.collect_list("channel")).alias("channels"),
            F.array_sort(F.collect_list("attribute")).alias("attrs"),
        )
        .filter(F.col("header").isNotNull())
    )

    upto = F.greatest(F.size("parts") - 1, F.coalesce(F.array_max(F.transform("attrs", lambda a: a["part_index"])), F.lit(-1)))

    def list_text(i: Column) -> Column:
        of_part = F.filter("attrs", lambda a: a["part_index"] == i)
        return F.concat(F.lit("["), F.array_join(of_part["text"], ","), F.lit("]"))

    lists = F.when(upto >= 0, F.transform(F.sequence(F.lit(0), upto), list_text)).otherwise(
        F.array().cast("array<string>")
    )
    whole = F.col("header").withField("multipart_count", F.size("parts"))
    whole = whole.withField("is_deep", F.exists("parts", lambda p: p["is_deep"]))
    body = F.struct(
        F.lit(1).alias("schema_version"),
        whole.alias("file"),
        "channels",
        F.array().cast("array<string>").alias("errors"),
    )
    head = F.to_json(body)
    value = F.concat(
        F.substr(head, F.lit(1), F.length(head) - 1),
        F.lit(',"parts":['),
        F.array_join(F.col("parts")["text"], ","),
        F.lit('],"attributes":{"parts":['),
        F.array_join(lists, ","),
        F.lit("]}}"),
    )
    return grouped.select(key, value.alias("value"))


def backfill(df: DataFrame, path: str, data_type: str, name: str, raw: str = RAW) -> DataFrame:
    """Add a column taken out of the kept payload; NULL where it is absent or unfit.

    A payload kept as VARIANT is read as it is; one kept as text is parsed for each new column.
    """
    kept = F.col(raw)
    parsed = kept if isinstance(df.schema[raw].dataType, T.VariantType) else F.try_parse_json(kept)
    return df.withColumn(name, F.try_variant_get(parsed, path, data_type))


def read_versions(*tables: DataFrame) -> DataFrame:
    """Tables of mixed schema versions as one; what a version lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
