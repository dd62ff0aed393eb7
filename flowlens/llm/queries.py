"""Registered queries of the package, each on its whole table with production parameters, and SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import (
    alignment,
    dart_minhash,
    exact_dedup,
    hidden_markov,
    licenses,
    mixing,
    packing,
    piece_bpe,
    quality_rules,
    run_length_index,
    spelling,
    token_counts,
    token_files,
)
from flowlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


@query("op1_token_files")
def op1(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_section_tokens")
def op2(spark, sf_dir):
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_pack_sequences")
def op4(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_piece_bpe")
def op10(spark, sf_dir):
    return piece_bpe.encode_and_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op5_decision_list")
def op5(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_license_scan")
def op6(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op7_exact_groups", exact_dedup.ORACLE)
def op7(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op9_hidden_markov")
def op9(spark, sf_dir):
    return hidden_markov.score(table(spark, sf_dir, "documents"))


@query("op3_repeated_passages")
def op3(spark, sf_dir):
    return run_length_index.remove_repeats(table(spark, sf_dir, "documents"))


@query("op8_near_classes")
def op8(spark, sf_dir):
    return dart_minhash.near_classes(table(spark, sf_dir, "documents"))


@query("op11_align_tokenizers")
def op11(spark, sf_dir):
    return alignment.align_tokenizers(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_source_mix", mixing.ORACLE)
def op12(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


@query("op13_spelling_groups")
def op13(spark, sf_dir):
    return spelling.variant_groups(table(spark, sf_dir, "documents"))
