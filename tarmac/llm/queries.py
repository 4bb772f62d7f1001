"""The registered queries of this subpackage: thin callers of the operators, and the SQL each is checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm import byte_bpe, lexical, merkle, mixing, pii, quality, sharding, simhash, token_counts, topk, toxicity, url_rules, winnowing
from tarmac.llm.oracles import LEXICAL_SQL, MERKLE_SQL, MIXING_SQL, PII_SQL, TOP_K_SQL, URL_SQL
from tarmac.session import cut_lineage

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHARDS = 40
URL_RULES = "('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    grouped = simhash.near_duplicates(simhash.add_fingerprints(docs, words=3))
    return grouped.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_with_next(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {URL_RULES} AS rules (host, path, verdict)")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.filter_pages(pages, rules).drop("url")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = docs.select("source", mixing.word_count(F.col("text")).alias("size"), "doc_id", F.xxhash64("text").alias("hash"))
    return mixing.plan_mix(sized, ["doc_id", "hash"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digest_documents(docs, RANKS, public_tokenizers.PATTERN)


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("bigint").alias("id"), topk.scaled(F.col("embedding")).alias("vector")
    )
    return topk.top_k(rows, F.col("id") % 100 == 0)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.add_scores(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [kind.name for kind in pii.KINDS if kind.base]
    spans = F.col("spans")
    places = ("kind", "start", "end")

    def of_kind(name: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("bigint")

    return found.select(
        "doc_id",
        *[of_kind(name).alias(f"n_{name}") for name in base],
        F.sha2(pii.joined(F.filter(spans, lambda s: s["kind"].isin(base)), *places), 256).alias("base_sha256"),
        pii.joined(spans, *places).alias("spans"),
        pii.joined(spans, *places, "score").alias("scored_spans"),
    )


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, docs = (_table(spark, sf_dir, name) for name in ("benchmark", "documents"))
    return lexical.search(items, docs, k=10)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    described = cut_lineage(quality.add_statistics(docs))
    scored = quality.fit_quality(described, labels).score_statistics(described)
    return scored.select(
        "doc_id",
        F.coalesce(quality.fold(F.col("doc_id")) == quality.HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = _table(spark, sf_dir, "documents").select(*fields)
    emptied = merkle.leaf(*map(F.col, fields[:-1]), F.translate("text", "\n", ""))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    made = merkle.manifest(docs, fields, carry={"changed": F.when(tampered, emptied)})
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("path"))
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_simhash": (op1_simhash, None),
    "op2_winnowing": (op2_winnowing, None),
    "op3_url_filters": (op3_url_filters, URL_SQL),
    "op4_mixing": (op4_mixing, MIXING_SQL),
    "op5_byte_bpe": (op5_byte_bpe, None),
    "op6_top_k": (op6_top_k, TOP_K_SQL),
    "op7_token_counts": (op7_token_counts, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_sharding": (op9_sharding, None),
    "op10_pii": (op10_pii, PII_SQL),
    "op11_lexical": (op11_lexical, LEXICAL_SQL),
    "op12_quality": (op12_quality, None),
    "op13_merkle": (op13_merkle, MERKLE_SQL),
}
