"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort.llm import bpe, exact, hardneg, langid, minhash, mixing, oracles, phrases, quality, substring, templates, trie, urls, vectors
from lumisort.llm.common import read_table

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    return bpe_digests(read_table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path(BYTE_RANKS)
    ranks = bpe.read_ranks(path)
    ids = F.col("ids")
    encoded = bpe.bpe_encode(docs, path, public_tokenizers.PATTERN)
    return bpe.with_table(encoded, "pieces", bpe.id_pieces(ranks), bpe.PIECE_TABLE).select(
        "doc_id", F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2("ids_le", 256).alias("ids_sha256"),
        F.sha2(bpe.decode_ids(ids, ranks, F.col("pieces")), 256).alias("decoded_sha256"))


def op10_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, fertility of the tokeniser and the verdict, per document."""
    return quality.quality_rules(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.fold(F.col("doc_id")) == 2, F.lit(False))
    model = langid.fit(docs.where(langid.fold(F.col("doc_id")) != 2))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected",
                                              "entropy")


def op2_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeated strings of 400 bytes cover."""
    out = substring.remove_repeated_bytes(read_table(spark, sf_dir, "documents"), 400)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


#: Parts of all tokens that the domains of the labels table should have.
MIX_TARGETS = {"clean": 0.92, "low": 0.06, "toxic": 0.02}
MIX_STRETCH = 1.05


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, F.lit("toxic")).when(F.col("quality") == 0, F.lit("low"))
                         .when(F.col("quality") == 1, F.lit("clean")).alias("domain"))


def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain membership and rate of every document."""
    rates, report = mixing.mixing_rates(read_table(spark, sf_dir, "documents"),
                                        label_domains(read_table(spark, sf_dir, "labels")), MIX_TARGETS,
                                        stretch=MIX_STRETCH)
    names = F.array(*[F.lit(x) for x in report.get("domains", [])]).cast("array<string>")
    likely = F.array_max("posterior")
    return rates.select("doc_id", F.col("tokens").alias("n_tokens"),
                        F.get(names, (F.array_position("posterior", likely) - 1).cast("int")).alias("domain"),
                        likely.alias("membership"), "rate")


def op4_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that passages of 13 words of earlier documents cover."""
    out = phrases.remove_repeated_passages(read_table(spark, sf_dir, "documents"), 13)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return vectors.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op6_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document and how many of them recur; what is left, as text digest."""
    out = templates.drop_recurring_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_dd_lines").cast("bigint").alias("n_lines"),
                      F.col("_dd_dropped").cast("bigint").alias("n_dropped"),
                      F.length("text").cast("bigint").alias("n_chars_kept"), F.sha2("text", 256).alias("kept_sha256"))


#: Fixed values of the contract of op8: (action, rule).
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op8_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or link-graph verdict of every page."""
    out = urls.url_verdicts(read_table(spark, sf_dir, "pages"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op11_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, size and verdict of every document among those of equal text."""
    return exact.exact_groups(read_table(spark, sf_dir, "documents"), keep="largest")


def op12_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each rebuilt on the first of its five."""
    conv = F.col("conv_id").cast("bigint")
    head = F.crc32(conv.cast("string").cast("binary")) % 9
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"), base=conv - conv % 5, head=head, borrowed=8)


def op13_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every 50th vector."""
    vec = F.col("vec_id")
    label = F.when(vec % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(read_table(spark, sf_dir, "embeddings"), label=label, anchor=vec % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_run_length_index": op2_run_length_index,
    "op3_soft_mixing": op3_soft_mixing,
    "op4_phrase_automata": op4_phrase_automata,
    "op5_pca_tiles": op5_pca_tiles,
    "op6_bbit_minhash": op6_bbit_minhash,
    "op7_template_lines": op7_template_lines,
    "op8_link_graph": op8_link_graph,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_tokeniser_fertility": op10_tokeniser_fertility,
    "op11_exact_groups": op11_exact_groups,
    "op12_zfast_trie": op12_zfast_trie,
    "op13_angular_negatives": op13_angular_negatives,
}

#: SQL of what SQL can express; the others are held against brute force in the tests.
ORACLE: dict[str, str] = {
    "op2_run_length_index": oracles.repeated_bytes_sql(400),
    "op4_phrase_automata": oracles.repeated_passages_sql(13),
    "op5_pca_tiles": oracles.near_vectors_sql(0.95),
    "op6_bbit_minhash": oracles.near_documents_sql(75),
    "op7_template_lines": oracles.template_lines_sql(),
    "op8_link_graph": oracles.url_verdicts_sql(URL_RULES),
    "op11_exact_groups": oracles.exact_groups_sql(),
    "op12_zfast_trie": oracles.prefix_trie_sql(),
    "op13_angular_negatives": oracles.hard_negatives_sql(),
}
