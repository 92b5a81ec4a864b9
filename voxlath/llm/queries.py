"""The opN_<name> queries, each an operator with its production parameters on whole tables."""

from __future__ import annotations

from . import chunked_bpe, host_quality, jaccard_join, line_dedup, ngram_lm, oracle_quality, oracle_text, sequence_packing, shard_store, token_rollup, toxic_crf, wu_manber
from .common import read


def op1_lm_scoring(spark, sf_dir):
    return ngram_lm.score_held_out(read(spark, sf_dir, "documents"), order=2)


def op2_quality_rules(spark, sf_dir):
    return host_quality.judge(read(spark, sf_dir, "documents"), ["doc_id"])


def op3_toxicity(spark, sf_dir):
    return toxic_crf.score_held_out(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_line_dedup(spark, sf_dir):
    return line_dedup.digests(read(spark, sf_dir, "documents"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.join(read(spark, sf_dir, "documents"), width=3, percent=90)


def op6_token_counts(spark, sf_dir):
    return token_rollup.replay(read(spark, sf_dir, "documents"))


def op7_decontamination(spark, sf_dir):
    return wu_manber.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), width=10)


def op8_bpe(spark, sf_dir):
    return chunked_bpe.digests(read(spark, sf_dir, "documents"))


def op9_sharding(spark, sf_dir):
    return shard_store.contents(read(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    return sequence_packing.written(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_token_counts": op6_token_counts,
    "op7_decontamination": op7_decontamination,
    "op8_bpe": op8_bpe,
    "op9_sharding": op9_sharding,
    "op10_packing": op10_packing,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": oracle_quality.SQL,
    "op4_line_dedup": oracle_text.LINES,
    "op5_jaccard_join": oracle_text.CLASSES,
    "op7_decontamination": oracle_text.WINDOWS,
    "op9_sharding": shard_store.SQL,
}
