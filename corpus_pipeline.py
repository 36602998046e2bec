"""From raw documents to token ids: five stages, each on all that the one before kept.

1. ``quality``: documents that the quality rules reject go.
2. ``lines``: lines of templates that recur across documents go, everywhere but in
   the first document; a document left without a word goes.
3. ``near_duplicates``: of each component of near-duplicate documents the one with
   the smallest id stays.
4. ``mixing``: a document stays with probability min(1, rate); rates make the
   expected tokens of each domain match the targets.  Nothing is repeated, as the
   corpus was just deduplicated.  The draw is a hash of the id, so it can be redone.
5. ``encode``: byte-level BPE, a row of digests per document.

Stages 1 to 4 return the columns of ``documents``; extra columns pass through.
Empty input gives empty output; null texts fail the quality rules.  Each stage first lets the driver
go of what the one before left behind.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort.llm import minhash, mixing, quality, queries, templates
from lumisort.llm.common import WORD_PATTERN, drop_stored, read_table, release, stored
from lumisort.operators.ranking import small_side


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return quality.keep_good(docs, public_tokenizers.path(queries.PIECE_MODEL))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    out = templates.drop_recurring_lines(docs)
    emptied = (F.col("_dd_dropped") > 0) & ~F.col("text").rlike(WORD_PATTERN)
    out = out.where(~emptied)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_dd_dropped") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the ids in ``gone``.  Texts are filtered in place where the ids are counted few, else joined by
    id.  A document without an id is known to no list of ids, so it stays."""
    gone = stored(gone.where(F.col("doc_id").isNotNull()).distinct(), "gone")
    return docs.join(small_side(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return without(docs, minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    rates, _ = mixing.mixing_rates(docs, queries.label_domains(read_table(spark, sf_dir, "labels")),
                                   queries.MIX_TARGETS, stretch=queries.MIX_STRETCH)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return without(docs, rates.where(draw >= F.col("rate")).select("doc_id"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return queries.bpe_digests(docs)


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_duplicate_stage),
          ("mixing", mixing_stage), ("encode", encode_stage)]

#: Tokenisation and the fits have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_stored(before)
    return STAGES[-1][1](spark, docs, sf_dir)
