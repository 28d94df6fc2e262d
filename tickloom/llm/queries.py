"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    bpe,
    centroids,
    jaccard,
    langid,
    lines,
    outliers,
    packing,
    periods,
    pii,
    quality_net,
    sharding,
    topk,
    urls,
)
from tickloom.llm.oracle import all_oracles as all_oracles

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
#: Longest rule wins, so the order does not matter.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


#: Whoever holds the key can link values to pseudonyms; a deployment passes its own.
PII_KEY = b"registered queries"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> tuple[str, str, str]:
    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op1_jaccard(spark, sf_dir):
    return jaccard.components(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_files())


def op3_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op4_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).select("doc_id", "text", F.size("pii").cast("long").alias("n_pii"))


def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    net = langid.train(docs.where(~F.col("held_out")))
    return langid.identify(docs.drop("lang"), net).select("doc_id", "held_out", "lang_pred", "score")


def op6_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


def op7_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(table(spark, sf_dir, "documents"), path)


def op8_sharding(spark, sf_dir):
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_quality(spark, sf_dir):
    return outliers.quality(table(spark, sf_dir, "documents"))


def op11_quality_net(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    net = quality_net.train(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels"))
    return quality_net.score(docs, net).select("doc_id", "held_out", "score", "predicted")


def op12_periods(spark, sf_dir):
    return periods.digests(table(spark, sf_dir, "documents"), rewrite=periods.looped)


def op13_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Query]:
    return {
        "op1_jaccard": op1_jaccard,
        "op2_packing": op2_packing,
        "op3_url_filter": op3_url_filter,
        "op4_pii": op4_pii,
        "op5_language": op5_language,
        "op6_line_dedup": op6_line_dedup,
        "op7_bpe": op7_bpe,
        "op8_sharding": op8_sharding,
        "op9_top_k": op9_top_k,
        "op10_quality": op10_quality,
        "op11_quality_net": op11_quality_net,
        "op12_periods": op12_periods,
        "op13_centroids": op13_centroids,
        "pipeline": pipeline,
    }
