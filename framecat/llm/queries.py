"""The registered queries of this subpackage, thin digests of its operators, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecat.llm import (
    alignment,
    exact_dedup,
    hard_negatives,
    kneser_ney,
    mixing,
    pieces,
    pivot_topk,
    quality_rules,
    severity,
    simhash,
    substrings,
    suffix_tree,
    warc,
)
from framecat.llm.common import documents

#: Where the public tokenizers' files are; the driver reads them, tasks get what they hold.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
PIECE_MODEL = os.path.join(TOKENIZERS, "piece_bpe_32k.model")
BYTE_FILE = os.path.join(TOKENIZERS, "byte_bpe_50k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).drop("raw")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = simhash.simhash_components(documents(spark, sf_dir))
    return told.select("doc_id", F.lower(F.hex("code")).alias("fingerprint"), "component_id")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = substrings.remove_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    return told.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept class_distance word_distance"
    return quality_rules.rules(documents(spark, sf_dir)).select(*names.split())


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    table = pieces.load(PIECE_MODEL)
    rows = documents(spark, sf_dir).select("doc_id", F.xxhash64(pieces.decodable("text")).alias("expected"), "text")
    told = pieces.decode(pieces.encode(rows, table), table)
    return told.select("doc_id", "token_ids", F.size("token_ids").alias("n_tokens"), (F.xxhash64("text") == F.col("expected")).alias("decoded"))


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_texts(documents(spark, sf_dir))


def op10_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = severity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return severity.severities(docs, model).drop("raw")


def op11_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = alignment.align(documents(spark, sf_dir), alignment.read_sides(BYTE_FILE, PIECE_MODEL))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return told.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, label=label)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc": op2_warc,
    "op3_mixing": op3_mixing,
    "op4_simhash": op4_simhash,
    "op5_substrings": op5_substrings,
    "op6_quality_rules": op6_quality_rules,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_pieces": op8_pieces,
    "op9_suffix_tree": op9_suffix_tree,
    "op10_severity": op10_severity,
    "op11_pivot_topk": op11_pivot_topk,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op1_exact_dedup": r"""
with t as (select doc_id, length(coalesce(text, '')) as points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
     r as (select *, row_number() over (partition by text_sha256 order by points desc, doc_id nulls last) as place,
                  first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id nulls last) as keep_id,
                  count(*) over (partition by text_sha256) as group_size from t)
select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from r""",
    "op2_warc": """
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
     f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from p)
select page_id, payload_bytes, payload_digest,
       case when page_id is distinct from first and first is not null then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from first and first is not null then first end as refers_to from f""",
    "op11_pivot_topk": """
with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as cells from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
     p as (select q.vec_id as query_id, r.vec_id, cast(list_inner_product(q.cells, r.cells) as bigint) as score
           from v as q join v as r on q.vec_id % 20 = 0 and len(q.cells) = len(r.cells) and (q.vec_id, q.cells) is distinct from (r.vec_id, r.cells)),
     o as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from p)
select query_id, rank, vec_id, score from o where rank <= 20""",
    "op13_hard_negatives": """
with v as (select distinct vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as cells from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
     p as (select a.vec_id as anchor_id, r.vec_id, a.label = r.label as alike, cast(list_inner_product(a.cells, r.cells) as bigint) as score
           from v as a join v as r on a.vec_id % 100 = 0 and len(a.cells) = len(r.cells) and (a.vec_id, a.cells) is distinct from (r.vec_id, r.cells)),
     s as (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from p where alike),
     n as (select s.anchor_id, s.vec_id as positive_id, s.score as positive_score, p.vec_id as negative_id, p.score as negative_score,
                  cast(row_number() over (partition by s.anchor_id, s.vec_id order by p.score desc, p.vec_id) as integer) as rank
           from s join p on p.anchor_id = s.anchor_id and not p.alike and s.place <= 5
                        and 30 * s.score <= 100 * p.score and 100 * p.score <= 90 * s.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10""",
}
