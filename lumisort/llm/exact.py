"""Exact dedup: rows of equal text, found by a 128-bit content hash and confirmed by bytes.

1. One scan of the texts writes a narrow table: id, 128-bit hash, SHA-256 and a row
   number of its own.  Everything that follows but step 3 reads that table.
2. Rows are counted by hash; counts and the row that stays are partial aggregates, so a
   group that holds a third of all rows is one row a task in the shuffle.  Hashes with
   one row need nothing more.
3. Inside the groups texts are compared by their bytes: ``groupBy(hash, text)``, again
   partially aggregated.  A hash with two different texts is a collision; its rows get
   the text itself as key and are grouped anew.
4. The groups are joined back to the narrow rows.  Hot groups (at least 1/2,000 of the rows,
   so 2,000 at most) are broadcast, the others joined by hash (``common.attach_groups``).

DataFrame functions only.  Defined results: a null text counts as empty, so null and
empty texts form one group.  Null ids come last in the order of ids, in either direction;
a group with null ids alone has a null ``keep_id``.  Of rows that repeat id and text one
stays.  Empty tables give empty results.  Other columns, whatever their names, are
carried by ``drop_exact_duplicates`` and not read by ``exact_groups``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisort.llm.common import attach_groups, drop_stored, stored
from lumisort.operators.ranking import small_side

KEEP = ("largest", "smallest")


def md5_128(text: Column) -> Column:
    """The 16 bytes of the text's MD5."""
    return F.unhex(F.md5(text))


def _groups(rows: DataFrame, keep: str) -> DataFrame:
    """(key, n, keep_id, keep_row) of the keys with two rows or more; written once."""
    pick, pick_by = (F.max, F.max_by) if keep == "largest" else (F.min, F.min_by)
    g = rows.groupBy("_dd_key").agg(F.count(F.lit(1)).alias("_dd_n"), pick("_dd_id").alias("_dd_keep"),
                                    F.coalesce(pick_by("_dd_row", "_dd_id"), F.min("_dd_row")).alias("_dd_keep_row"))
    return stored(g.where(F.col("_dd_n") > 1), "exact-groups")


def _collisions(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """Keys that rows with different bytes share.  Where the groups are few, texts outside
    them are left out before the shuffle; beyond that all texts go, with the same result."""
    keys = groups.select("_dd_key")
    few = small_side(keys, keys.count())
    inside = texts.join(few, "_dd_key", "left_semi") if few is not keys else texts
    kinds = inside.groupBy("_dd_key", "_dd_text").agg(F.count(F.lit(1)).alias("_dd_n"))
    return stored(kinds.groupBy("_dd_key").agg(F.count(F.lit(1)).alias("_dd_kinds"))
                  .where(F.col("_dd_kinds") > 1).select("_dd_key"), "exact-collisions")


def _keyed(docs: DataFrame, id_col: str, text_col: str, normalise, content_hash) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    return docs.select(F.col(id_col).alias("_dd_id"), text.alias("_dd_text")).withColumn("_dd_key", content_hash("_dd_text"))


def _match(docs: DataFrame, id_col, text_col, keep, normalise, content_hash) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(narrow rows, their groups, colliding hashes), each written once."""
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}")
    texts = _keyed(docs, id_col, text_col, normalise, content_hash)
    sha = F.unhex(F.sha2("_dd_text", 256)).alias("_dd_sha")
    row = F.monotonically_increasing_id()
    rows = stored(texts.select("_dd_id", "_dd_key", sha, row.alias("_dd_row")), "exact-rows")
    groups = _groups(rows, keep)
    mixed = _collisions(texts, groups)
    if not mixed.isEmpty():
        whole = F.concat("_dd_key", F.encode("_dd_text", "UTF-8")).alias("_dd_key")
        apart = texts.join(mixed, "_dd_key", "left_semi").select("_dd_id", whole, sha, (-1 - row).alias("_dd_row"))
        old, old_groups = rows, groups
        rows = stored(rows.join(mixed, "_dd_key", "left_anti").select(*rows.columns).unionByName(apart), "exact-rows")
        groups = _groups(rows, keep)
        drop_stored(old, old_groups)
    return rows, groups, mixed


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                 normalise: Callable[[Column], Column] | None = None,
                 content_hash: Callable[[str], Column] = md5_128) -> DataFrame:
    """Per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep``: the row with the largest or the smallest id stays.  ``normalise`` maps the
    text column before it is compared (default: no change).  ``content_hash`` gives the
    key as binary; any hash gives right results, as bytes are compared."""
    rows, groups, mixed = _match(docs, id_col, text_col, keep, normalise, content_hash)
    drop_stored(mixed)
    out = attach_groups(rows, groups, "_dd_key", "_dd_n", "_dd_row")
    grouped = F.col("_dd_n").isNotNull()
    return out.select(F.col("_dd_id").alias(id_col),
                      F.when(grouped, F.col("_dd_keep")).otherwise(F.col("_dd_id")).alias("keep_id"),
                      F.coalesce("_dd_n", F.lit(1)).cast("bigint").alias("group_size"),
                      F.coalesce(F.col("_dd_row") == F.col("_dd_keep_row"), F.lit(True)).alias("kept"),
                      F.lower(F.hex("_dd_sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                          normalise: Callable[[Column], Column] | None = None,
                          content_hash: Callable[[str], Column] = md5_128) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep.  Where few groups have
    copies, rows are filtered in place; rows of an id that is itself repeated are cut to one."""
    rows, groups, mixed = _match(docs, id_col, text_col, keep, normalise, content_hash)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_dd_doc")
    wide = docs.select(whole, F.col(id_col).alias("_dd_id"), text.alias("_dd_text")).withColumn("_dd_key", content_hash("_dd_text"))
    if not mixed.isEmpty():
        hit = F.broadcast(mixed) if mixed.count() <= 1000 else mixed
        wide = wide.join(hit.withColumn("_dd_mixed", F.lit(True)), "_dd_key", "left").withColumn(
            "_dd_key", F.when(F.col("_dd_mixed"), F.concat("_dd_key", F.encode("_dd_text", "UTF-8"))).otherwise(F.col("_dd_key")))
    wide = wide.select("_dd_doc", "_dd_id", "_dd_key", F.monotonically_increasing_id().alias("_dd_row"))
    # the rows' own numbers are not used here: groups name the id that stays
    joined = attach_groups(wide, groups.drop("_dd_keep_row"), "_dd_key", "_dd_n", "_dd_row")
    alone = joined.where(F.col("_dd_n").isNull()).select("_dd_doc.*")
    chosen = (joined.where(F.col("_dd_n").isNotNull() & F.col("_dd_id").eqNullSafe(F.col("_dd_keep")))
              .groupBy("_dd_key").agg(F.first("_dd_doc").alias("_dd_doc")).select("_dd_doc.*"))
    drop_stored(rows)
    return alone.unionByName(chosen).select(*[F.col(f"`{c}`") for c in docs.columns])
