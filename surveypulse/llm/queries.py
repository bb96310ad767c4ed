"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from surveypulse.llm.ann import nearest
from surveypulse.llm.bpe import bpe_encode
from surveypulse.llm.chat import conversations
from surveypulse.llm.common import table, tokenizer_file
from surveypulse.llm.divergence import oracle as divergence_sql
from surveypulse.llm.divergence import source_divergence
from surveypulse.llm.merkle import merkle_manifest
from surveypulse.llm.merkle import oracle as merkle_sql
from surveypulse.llm.minhash import minhash_dedup
from surveypulse.llm.oracle import near_sql, substring_sql
from surveypulse.llm.packing import best_fit_packing
from surveypulse.llm.pii import personal_data
from surveypulse.llm.quality import oracle as quality_sql
from surveypulse.llm.quality import quality_rules
from surveypulse.llm.scoring import lm_scores
from surveypulse.llm.substring_dedup import substring_dedup
from surveypulse.llm.suffix_dedup import suffix_dedup
from surveypulse.llm.url_filters import oracle as url_sql
from surveypulse.llm.url_filters import url_verdicts


def op1_substring_dedup(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", "_q.*")


def op3_packing(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op4_minhash(spark, sf_dir):
    return minhash_dedup(table(spark, sf_dir, "documents"), size=3, similar=85)


def op5_bpe(spark, sf_dir):
    return bpe_encode(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op7_chat(spark, sf_dir):
    return conversations(table(spark, sf_dir, "conversations"))


def op8_ann(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))


def op9_pii(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


def op11_url_filters(spark, sf_dir):
    return url_verdicts(table(spark, sf_dir, "pages"))


def op12_source_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle_manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_quality_rules, op3_packing, op4_minhash, op5_bpe, op6_suffix_dedup, op7_chat, op8_ann, op9_pii, op10_lm_scoring,
    op11_url_filters, op12_source_divergence, op13_merkle_manifest)}
ORACLE: dict[str, str] = {
    "op1_substring_dedup": substring_sql(),
    "op2_quality_rules": quality_sql(),
    "op4_minhash": near_sql(),
    "op11_url_filters": url_sql(),
    "op12_source_divergence": divergence_sql(),
    "op13_merkle_manifest": merkle_sql(),
}
