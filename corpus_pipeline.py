"""A training-data pipeline over ``documents``: each stage works on what the one before wrote.

Quality rules drop documents, near-duplicates leave one document of each group, repeated passages
are cut out, personal data is replaced by its kind, and the rest is packed into token sequences. A stage
starts when the one before is written, and first removes the tables that earlier stages kept for
themselves in the shared folder, so at most two stages' tables stand there. All stages but the last return the columns of ``documents``; ``n_chars`` follows a changed text. Stages
bear further columns in ``docs``, of any name, and pass them on.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveypulse.llm.common import forget_tables, remove_tables, table, tokenizer_file, written
from surveypulse.llm.minhash import minhash_dedup
from surveypulse.llm.packing import best_fit_packing
from surveypulse.llm.pii import personal_data
from surveypulse.llm.quality import quality_rules
from surveypulse.llm.substring_dedup import substring_dedup

TOKENIZER = "word_bpe_49k.json"
#: The columns that stages work with; any others travel in one struct, so their names can't clash.
OWN = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def passing_others(stage: Stage) -> Stage:
    """The stage on the columns it works with, with the other columns of its rows beside them."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        others = [c for c in names if c not in OWN]
        if not others:
            return stage(spark, docs, sf_dir)
        held = F.struct(*[docs[f"`{c}`"].alias(c) for c in others]).alias("others")
        out = stage(spark, docs.select(*[c for c in names if c in OWN], held), sf_dir)
        return out.select(*[F.col(c) if c in OWN else F.col("others")[c].alias(c) for c in names])

    return run_stage


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where the documents have that column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@passing_others
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep: of no text, blank or few words, or outliers, they go. Rows that
    repeat are judged alike and stay as often as they were."""
    forget_tables(spark)
    return quality_rules(docs, keep=tuple(docs.columns)).where("_q.kept").select(*docs.columns)


@passing_others
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near-duplicates, its repeated rows once. Documents without
    an id can't be told apart and stay."""
    remove_tables(spark, docs)
    kept = minhash_dedup(docs).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    stays = docs.join(kept, F.col("doc_id") == F.col("_kept_id"), "left_semi")
    once = stays.withColumn("_text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash")
    return once.union(docs.where("doc_id IS NULL"))


@passing_others
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; a document left without words goes."""
    remove_tables(spark, docs)
    cut = substring_dedup(docs, keep=True).where("_n_removed = 0 OR _n_removed < _n_words")
    return counted(cut.select(*docs.columns))


@passing_others
def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data is replaced by its kind in angle brackets; null and empty texts stay."""
    remove_tables(spark, docs)
    return counted(personal_data(docs, keep=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in their sequences; a null or empty text is one piece of the end id alone."""
    remove_tables(spark, docs)
    return best_fit_packing(docs, tokenizer_file(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_quality),
    ("minhash near-dedup", one_of_each),
    ("substring dedup", cut_repeats),
    ("personal data", hide_personal_data),
    ("best-fit packing", pack),
]

#: No SQL: stages iterate, tokenize and pack. Tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
