"""The registered queries of these operators: production parameters over whole tables.

Each derives the digest columns that the checks compare from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import block_anchors, collision_index, host_rules, pii_crf, simhash_index, suffix_repeats, toxicity
from logloom.llm.curve_packing import pack_along_curve
from logloom.llm.filter_audit import audit
from logloom.llm.piece_tokens import encode_pieces
from logloom.llm.sql import ORACLES
from logloom.llm.token_files import read_token_files, write_token_files
from logloom.llm.url_filter import ALLOW, BLOCK, as_entries, judge_urls
from logloom.llm.whitening import whiten
from logloom.plans.scratch import scratch_path

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
URL_RULES = [
    ("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK)]
#: A small block list of the invented web: advertising, betting, pills, spam and adult content.
BLOCKED_HOSTS = [
    "ads-track.example.com/", "casino-win.example.net/", "cheap-pills.example.net/", "free-bets.example.net/",
    "spam-farm.example.org/", "adult-x.example.com/"]
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_host_rules(spark, sf_dir):
    judged = host_rules.host_quality(_documents(spark, sf_dir), with_text=False)
    return judged.select("doc_id", *host_rules.MEASURES, "base_failed", "kept", "host_failed")


def op2_block_anchors(spark, sf_dir):
    return block_anchors.repeat_digests(_documents(spark, sf_dir))


def op3_token_files(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    write_token_files(_documents(spark, sf_dir), path, BYTE_TOKENIZER)
    return read_token_files(spark, path, with_ids=False)


def op4_curve_packing(spark, sf_dir):
    return pack_along_curve(_documents(spark, sf_dir), BYTE_TOKENIZER, with_ids=False)


def op5_simhash_index(spark, sf_dir):
    found = simhash_index.near_duplicates(_documents(spark, sf_dir))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op6_piece_tokens(spark, sf_dir):
    return encode_pieces(_documents(spark, sf_dir), PIECE_MODEL, digests=True)


def op7_suffix_repeats(spark, sf_dir):
    return suffix_repeats.suffix_digests(_documents(spark, sf_dir))


def op8_pii_crf(spark, sf_dir):
    return pii_crf.find_personal_data(_documents(spark, sf_dir))


def op9_collision_index(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return collision_index.nearest(rows, F.col("vec_id") % 100 == 0)


def op10_toxicity(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op11_whitening(spark, sf_dir):
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_url_filters(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    blocked = as_entries(spark, [(entry, BLOCK) for entry in BLOCKED_HOSTS])
    return judge_urls(pages, as_entries(spark, URL_RULES), blocked).select("page_id", "host", "path", "rule", "verdict")


def op13_filter_audit(spark, sf_dir):
    return audit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_host_rules": op1_host_rules,
    "op2_block_anchors": op2_block_anchors,
    "op3_token_files": op3_token_files,
    "op4_curve_packing": op4_curve_packing,
    "op5_simhash_index": op5_simhash_index,
    "op6_piece_tokens": op6_piece_tokens,
    "op7_suffix_repeats": op7_suffix_repeats,
    "op8_pii_crf": op8_pii_crf,
    "op9_collision_index": op9_collision_index,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_url_filters": op12_url_filters,
    "op13_filter_audit": op13_filter_audit,
}

__all__ = ["ORACLES", "QUERIES"]
