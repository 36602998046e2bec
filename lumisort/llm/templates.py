"""Line deduplication by a log-template tree of fixed depth, in DataFrame functions only.

Every line goes down a tree of fixed depth to a leaf: first its number of tokens,
then its first ``depth`` tokens, tokens with a digit counting as the variable field
``<*>``.  A leaf has as many templates as its lines need.  Two lines of n tokens with at
least ``similarity`` of them equal, place by place, differ in k = (1 - similarity) n places
at most, so of k + 1 segments of their other tokens they share one.  The commonest line of
every bucket (leaf, segment, its tokens) is its seed.  A line that resembles no seed of its buckets
is a template; any other joins the commonest template among the seeds that it resembles
(the places that differ are variable fields) or, if none of them is one, stands for itself.
Ties between equally common lines go to the larger hash.  Every line is held against k + 1
seeds, so the work is linear in the lines and there are no rounds.

Lines that have no constant part to tell them by, of fewer than ``min_tokens`` tokens or with
variable fields in more than half of their places, are not generalised: they are the same
where all their tokens are.  Lines without a token stay.

A template that two documents or more hold recurs: its lines are dropped everywhere but in the
first such document (smallest id), so that text with copies loses all copies and keeps one.

Skew: lines travel as narrow (key, place, hash) rows; first and last document are
partial aggregates; a hot line or leaf is the large side of a join with a table of
one row per key, which adaptive execution splits.

Null text stays null and has no lines.  Rows that repeat id and text are one
document and each is returned.  Other columns pass through; helper columns start
with ``_dd_`` and don't clash.  Texts are split at ``\\n`` and joined again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisort.llm.common import let, stored

TOKEN_WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
FIELD = "<*>"


def tokens_of(line: Column) -> Column:
    """The line's tokens, joined by one space; ``line`` holds no ``\\n``."""
    for blank in "\t\x0b\x0c\r":
        line = F.replace(line, F.lit(blank), F.lit(" "))
    return let(line, lambda x: F.trim(F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " +", " ")).otherwise(x)))


def masked(tokens: Column) -> Column:
    """``tokens_of`` a line with ``<*>`` for every token with a digit."""
    return F.when(tokens.rlike("[0-9]"), F.regexp_replace(tokens, TOKEN_WITH_DIGIT, FIELD)).otherwise(tokens)


def _count(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def _same_share(a: Column, b: Column, n: Column) -> Column:
    same = F.zip_with(F.split(a, " "), F.split(b, " "), lambda x, y: x == y)
    return F.size(F.filter(same, lambda x: x)) / n


def template_lines(docs: DataFrame, key: str, id_col: str, text_col: str, depth: int, min_tokens: int) -> DataFrame:
    """The narrow table of lines: key, id, place, tokens, whether fields vary, hash, leaf."""

    def known_by(own: Column) -> Column:
        """What a line is recognised by: its masked tokens; for lines of fields its own tokens after a line feed, which no
        line holds, so the two kinds don't meet.  Most lines have no digit and are known by their tokens at once."""
        with_fields = let(F.regexp_replace(own, TOKEN_WITH_DIGIT, FIELD), lambda m: F.when(
            2 * _count(m, FIELD) <= F.when(_count(m, " ") + 1 >= min_tokens, _count(m, " ") + 1).otherwise(0), m).otherwise(F.concat(F.lit("\n"), own)))
        return F.when(own.rlike("[0-9]"), with_fields).otherwise(own)

    # masked before they are exploded: a column of the generator is computed once
    known = F.transform(F.split(F.col(text_col), "\n", -1), lambda x: let(tokens_of(x), known_by))
    lines = docs.select(key, F.col(id_col).alias("_dd_id"), F.posexplode(known).alias("_dd_at", "_dd_line"))
    line, n = F.col("_dd_line"), F.col("_dd_n")
    vary = ~line.startswith("\n") & (n >= min_tokens) & (2 * _count(line, FIELD) <= n)
    return (lines.where(line != "").withColumn("_dd_n", _count(line, " ") + 1)
            .select(key, "_dd_id", "_dd_at", "_dd_n", vary.alias("_dd_vary"), F.unhex(F.md5(line)).alias("_dd_hash"),
                    F.xxhash64(n, F.substring_index(line, " ", depth)).alias("_dd_leaf")))


def segments(line: Column, n: Column, depth: int, similarity: float) -> Column:
    """Hashes of the segments of the tokens after the first ``depth``: one more than the places that similar lines
    differ in."""
    differ = F.floor(n * (1 - similarity) + 1e-9).cast("int")
    rest = n - depth
    count = F.least(rest, differ + 1)
    return let(F.split(line, " "), lambda t: F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(
        i, F.array_join(F.slice(t, depth + 1 + F.floor(i * rest / count).cast("int"),
                                (F.floor((i + 1) * rest / count) - F.floor(i * rest / count)).cast("int")), " "))))


def merged_templates(docs: DataFrame, distinct: DataFrame, key: str, text_col: str, similarity: float,
                     min_merge_tokens: int, depth: int) -> DataFrame:
    """(hash, template): lines that join another line's template."""
    can = distinct.where(F.col("_dd_vary") & (F.col("_dd_n") >= max(min_merge_tokens, depth + 1)))
    leaves = can.groupBy("_dd_leaf").agg(F.count(F.lit(1)).alias("_dd_lines")).where(F.col("_dd_lines") > 1).select("_dd_leaf")
    unsure = can.join(leaves, "_dd_leaf").select(
        F.col(f"_dd_first.{key}").alias(key), F.struct("_dd_hash", "_dd_leaf", "_dd_n", "_dd_k", F.col(
            "_dd_first._dd_at").alias("_dd_at")).alias("_dd_w"))
    # the texts of the lines in question, fetched from one document each
    wanted = unsure.groupBy(key).agg(F.collect_list("_dd_w").alias("_dd_w"))
    one_each = docs.select(key, F.col(text_col).alias("_dd_text")).join(wanted, key)
    texts = (one_each.select(F.split("_dd_text", "\n", -1).alias("_dd_split"), F.explode("_dd_w").alias("_dd_w"))
             .select("_dd_w.*", masked(tokens_of(F.get("_dd_split", F.col("_dd_w._dd_at")))).alias("_dd_line"))
             .select("_dd_hash", "_dd_leaf", "_dd_n", "_dd_k", "_dd_line")
             .dropDuplicates(["_dd_hash"]))  # repeated rows of a document
    texts = stored(texts, "leaf-lines")
    # every line meets the seeds of its buckets: the commonest, of equally common ones that with the largest hash
    place = F.explode(segments(F.col("_dd_line"), F.col("_dd_n"), depth, similarity))
    held = texts.select("_dd_hash", "_dd_k", "_dd_leaf", place.alias("_dd_segment"))
    seeds = (held.groupBy("_dd_leaf", "_dd_segment").agg(F.max(F.struct("_dd_k", "_dd_hash")).alias("_dd_seed"),
                                                        F.count(F.lit(1)).alias("_dd_lines")).where(F.col("_dd_lines") > 1))
    met = (held.join(seeds, ["_dd_leaf", "_dd_segment"]).where(F.col("_dd_hash") != F.col("_dd_seed._dd_hash"))
           .select("_dd_hash", F.col("_dd_seed._dd_hash").alias("_dd_by")).distinct())
    of_seed = texts.select(F.col("_dd_hash").alias("_dd_by"), F.col("_dd_line").alias("_dd_other"), F.col("_dd_k").alias("_dd_often"))
    near = (texts.select("_dd_hash", "_dd_n", "_dd_line").join(met, "_dd_hash").join(of_seed, "_dd_by")
            .where(_same_share(F.col("_dd_line"), F.col("_dd_other"), F.col("_dd_n")) >= similarity)
            .select("_dd_hash", "_dd_by", "_dd_often"))
    near = stored(near, "near-seeds")
    # seeds that resemble a commoner one are no templates
    joins = near.join(near.select(F.col("_dd_hash").alias("_dd_by")).distinct(), "_dd_by", "left_anti")
    return (joins.groupBy("_dd_hash").agg(F.max(F.struct("_dd_often", "_dd_by")).alias("_dd_best"))
            .select("_dd_hash", F.col("_dd_best._dd_by").alias("_dd_template")))


def drop_recurring_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 3,
                         similarity: float = 0.7, min_tokens: int = 2, min_merge_tokens: int = 6) -> DataFrame:
    """``df`` with the text shortened, plus ``_dd_lines`` and ``_dd_dropped`` (line counts)."""
    key = "_dd_key"
    docs = df.withColumn(key, F.when(F.col(text_col).isNotNull(), F.unhex(F.md5(F.concat(
        F.coalesce(F.col(id_col).cast("string"), F.lit("\0")), F.lit(":"), F.col(text_col))))))
    with_text = docs.where(F.col(key).isNotNull())
    lines = stored(template_lines(with_text, key, id_col, text_col, depth, min_tokens), "template-lines")
    # one row per distinct line: how often, and the first and last document that holds it
    distinct = stored(lines.groupBy("_dd_hash", "_dd_leaf", "_dd_n", "_dd_vary").agg(
        F.count(F.lit(1)).alias("_dd_k"), F.min(F.struct("_dd_id", key, "_dd_at")).alias("_dd_first"),
        F.max(F.struct("_dd_id", key)).alias("_dd_last")), "distinct-lines")
    merged = merged_templates(with_text, distinct, key, text_col, similarity, min_merge_tokens, depth)
    held = distinct.join(merged, "_dd_hash", "left").select(
        "_dd_hash", F.coalesce("_dd_template", "_dd_hash").alias("_dd_template"),
        F.struct("_dd_first._dd_id", f"_dd_first.{key}").alias("_dd_first"), "_dd_last")
    # a template recurs if its first and last documents differ
    recurring = (held.groupBy("_dd_template")
                 .agg(F.min("_dd_first").alias("_dd_lo"), F.max("_dd_last").alias("_dd_hi"))
                 .where(F.col(f"_dd_lo.{key}") != F.col(f"_dd_hi.{key}"))
                 .select("_dd_template", F.col(f"_dd_lo.{key}").alias("_dd_keeper")))
    of_line = held.select("_dd_hash", "_dd_template").join(recurring, "_dd_template").select("_dd_hash", "_dd_keeper")
    dropped = (lines.select("_dd_hash", key, "_dd_at").join(of_line, "_dd_hash")
               .where(F.col(key) != F.col("_dd_keeper"))
               .groupBy(key).agg(F.collect_set("_dd_at").alias("_dd_drop")))
    out = docs.join(dropped, key, "left")
    split = F.split(F.col(text_col), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_dd_drop"))
    left = let(split, lambda parts: F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n"))
    text = F.when(F.col("_dd_drop").isNull(), F.col(text_col)).otherwise(left)
    return (out.withColumn("_dd_lines", F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(split)))
            .withColumn("_dd_dropped", F.coalesce(F.size("_dd_drop"), F.lit(0)))
            .withColumn(text_col, text).drop(key, "_dd_drop"))
