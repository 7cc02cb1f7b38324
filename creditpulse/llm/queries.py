"""Registered queries of the corpus operators, with production parameters."""

from __future__ import annotations



import public_tokenizers
from pyspark.sql import functions as F

from creditpulse.llm import bpe_codec
from creditpulse.llm.collocations import collocations
from creditpulse.llm.common import table
from creditpulse.llm.embedding_dedup import near_vectors
from creditpulse.llm.lexical_search import search
from creditpulse.llm.lm_scoring import score_documents
from creditpulse.llm.mixing import Mixture
from creditpulse.llm.oracle import ORACLES  # noqa: F401  registered with the queries
from creditpulse.llm.quality_rules import quality
from creditpulse.llm.secret_scans import scan_documents
from creditpulse.llm.sentencepiece_codec import encode
from creditpulse.llm.simhash_dedup import near_duplicates
from creditpulse.llm.token_counts import count_tokens
from creditpulse.llm.toxicity import score, train
from creditpulse.llm.url_filters import judge_urls

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def op1_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                        public_tokenizers.PATTERN)


def op2_sentencepiece(spark, sf_dir):
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op4_lm_scoring(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))


def op5_url_filters(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_mixing(spark, sf_dir):
    return Mixture(table(spark, sf_dir, "documents")).documents.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op7_embedding_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_quality_rules(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_secret_scans(spark, sf_dir):
    return scan_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op11_bpe_codec(spark, sf_dir):
    out = bpe_codec.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), decoded_col="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark, sf_dir):
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_sentencepiece, op3_toxicity, op4_lm_scoring, op5_url_filters, op6_mixing, op7_embedding_dedup, op8_simhash, op9_quality_rules,
                                   op10_secret_scans, op11_bpe_codec, op12_collocations, op13_lexical_search)}
