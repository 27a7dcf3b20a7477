"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from tallow.llm import (compression_bands, conversation_repair, embedding_dedup, language_id, lexical_search, licences,
                        mixing, near_dedup, packing, spotsigs, token_files, toxicity, warc)
from tallow.llm.common import table


def op1_warc_merge(spark, sf_dir):
    """Every page's record, from the merged capture index of its archives."""
    return warc.page_report(table(spark, sf_dir, "pages"))


def op2_spotsigs(spark, sf_dir):
    """SpotSigs fingerprints of every document and of its edited text."""
    return spotsigs.fingerprint_report(table(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    """Predicted language of every document."""
    return language_id.language_report(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark, sf_dir):
    """Near-duplicate component of every document, on 4-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op5_mixing(spark, sf_dir):
    """Words each document gives to the mix of sources at 5:2:1."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_token_files(spark, sf_dir):
    """Offsets, lengths and checksums of every document in the token files."""
    return token_files.token_report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    """Toxicity score and nearest labelled examples of every document."""
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_licences(spark, sf_dir):
    """Known licences that a document, or lines of it, consist of."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_compression_bands(spark, sf_dir):
    """Base metrics, compression ratios and verdict of every document."""
    return compression_bands.quality_report(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark, sf_dir):
    """The 50 best documents of every benchmark item, by presence masks."""
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark, sf_dir):
    """Faults, cheapest repair and its digest of every damaged conversation."""
    return conversation_repair.damage_report(table(spark, sf_dir, "conversations"))


def op13_embedding_dedup(spark, sf_dir):
    """Links and component of every vector, within its label."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_warc_merge, op2_spotsigs, op3_language_id, op4_near_dedup, op5_mixing, op6_token_files, op7_toxicity, op8_licences,
                                  op9_compression_bands, op10_packing, op11_lexical_search, op12_conversation_repair, op13_embedding_dedup)}
ORACLE = {"op5_mixing": mixing.ORACLE_SQL, "op8_licences": licences.ORACLE_SQL,
          "op11_lexical_search": lexical_search.ORACLE_SQL}
