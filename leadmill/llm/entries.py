"""The numbered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from . import audio, chat, decontam, licenses, linededup, mixing, quality, ranked, sharding, simhash, tokens, trie, warc
from .common import table
from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_mixing_sources(spark, sf_dir):
    return mixing.digests(table(spark, sf_dir, "documents"))


def op2_media_columns(spark, sf_dir):
    return audio.digests(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark, sf_dir):
    return linededup.digests(table(spark, sf_dir, "documents"))


def op4_license_scans(spark, sf_dir):
    return licenses.digests(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_classifier(spark, sf_dir):
    return quality.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark, sf_dir):
    return sharding.digests(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark, sf_dir):
    return chat.digests(table(spark, sf_dir, "conversations"))


def op9_simhash_near_dedup(spark, sf_dir):
    return simhash.digests(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    return warc.digests(table(spark, sf_dir, "pages"))


def op11_ranked_search(spark, sf_dir):
    return ranked.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_counts(spark, sf_dir):
    return tokens.digests(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark, sf_dir):
    return trie.digests(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_mixing_sources": op1_mixing_sources,
    "op2_media_columns": op2_media_columns,
    "op3_line_dedup": op3_line_dedup,
    "op4_license_scans": op4_license_scans,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_sharding": op7_sharding,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_warc": op10_warc,
    "op11_ranked_search": op11_ranked_search,
    "op12_token_counts": op12_token_counts,
    "op13_conversation_trie": op13_conversation_trie,
}

