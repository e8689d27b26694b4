"""Queries of the training-data operators over the given tables (registered only by ``__spark_entry__``)."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers

from pyspark.sql import functions as F

import corpus_pipeline
from panelkit.llm import (bwt_dedup, byte_bpe, chat_format, cotrain_quality, cross_polytope, merkle_manifest, phrase_print,
                          repetition_rules, simhash_dedup, soft_mixing, superkmer_dedup, token_store, whitening)
from panelkit.llm.common import shared_path, table

QUERIES, ORACLE = {}, {}


def all_queries():
    """The operators' queries and the pipeline over the given tables."""
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def all_oracles():
    return {**ORACLE, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("op3_phrase_print")
def op3_phrase_print(spark, sf_dir):
    return phrase_print.compare_spliced(table(spark, sf_dir, "documents"))


@functools.cache
def _decimal(size: int) -> list[str]:
    return [str(i) for i in range(size)]


def bpe_digests(encoded, ranks_path: str):
    """n_tokens, the digest of the ids and that of the bytes decoded through the offsets, from the operator's rows."""

    def run(batches):
        words = _decimal(len(byte_bpe.vocabulary(ranks_path)))
        for batch in batches:
            lists = batch.column(1)
            flat, at = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            places = batch.column(2).flatten().to_numpy()
            parts = [flat[a:b] for a, b in zip(at, at[1:])]
            # two spans that meet in the middle of the bytes: decoding starts where the offsets say
            texts = [(x, places[a:b], int(places[(a + b) // 2]) if b > a else 0) for x, a, b in zip(parts, at, at[1:])]
            decoded = [byte_bpe.decode_span(x, o, 0, m, ranks_path) + byte_bpe.decode_span(x, o, m, 1 << 62, ranks_path) for x, o, m in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in parts], pa.int64()),
                 pa.array([hashlib.sha256(" ".join(map(words.__getitem__, x.tolist())).encode()).hexdigest() for x in parts], pa.string()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op4_byte_bpe")
def op4_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_digests(byte_bpe.encode(table(spark, sf_dir, "documents"), path), path)


@query("op5_token_store")
def op5_token_store(spark, sf_dir):
    path = shared_path(spark, "token-store")
    token_store.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.checksums(spark, path)


@query("op6_bwt_dedup")
def op6_bwt_dedup(spark, sf_dir):
    out = bwt_dedup.remove(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_simhash")
def op7_simhash(spark, sf_dir):
    out = simhash_dedup.cluster(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op8_superkmer_dedup")
def op8_superkmer_dedup(spark, sf_dir):
    out = superkmer_dedup.remove(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query("op1_soft_mixing")
def op1_soft_mixing(spark, sf_dir):
    out = soft_mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "tokens", *(F.col("p")[k].alias(f"p_{name}") for k, name in enumerate(soft_mixing.DOMAINS)), "rate", "gap")


@query("op2_cotrain_quality")
def op2_cotrain_quality(spark, sf_dir):
    out = cotrain_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "text_score", "meta_score", "score", (F.col("score") >= cotrain_quality.LIMIT).alias("accepted"))


@query("op9_cross_polytope")
def op9_cross_polytope(spark, sf_dir):
    return cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op10_chat_format", chat_format.SQL)
def op10_chat_format(spark, sf_dir):
    return chat_format.render(table(spark, sf_dir, "conversations"))


@query("op11_repetition_rules", repetition_rules.sql())
def op11_repetition_rules(spark, sf_dir):
    return repetition_rules.judge(table(spark, sf_dir, "documents")).drop("gram_chars")


@query("op12_merkle_manifest", merkle_manifest.sql())
def op12_merkle_manifest(spark, sf_dir):
    return merkle_manifest.prove(table(spark, sf_dir, "documents")).drop("n_leaves")


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
