"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

* Every document becomes the set of its distinct 5-word shingles (64-bit hashes) and
  a signature: per hash function, the low ``BITS`` bits of the smallest hash, packed
  as bit planes.  Documents with equal sets are one class, named by its smallest id.
* Class representatives that agree on all values of a band share a bucket.  Each
  member is paired with the smallest id of its buckets that looks most similar.
* Similarity is estimated by bit counts over the planes, corrected for chance
  agreement of ``BITS`` bits.  Pairs whose estimate lies well below the threshold go;
  the rest is confirmed on the full sets of both texts.
* Components come from the confirmed links.  In buckets that still hold several
  components, members outside the bucket's largest are compared, in blocks and with
  longer signatures, with the members of other components: first each is tried on
  the one that looks most similar, which joins most of them, then whoever is left on
  all that could reach the threshold.  Pairs inside a component need no comparison,
  so no link between components is missed that a bucket shows.

Copies collapse into classes, and a bucket gives at most one pair a member until the
last step, whose pairs are those that only full sets can tell apart.  Blocks bound
what a task holds; the texts of a leader's members are confirmed in salted groups of
about ``GROUP`` with a copy of the leader's text in each.

Empty sets (null text, no words) link with nothing.  Rows with one id are one
document.  Rows without an id are returned with null component and kept.  Only the
id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lumisort.llm.common import bound_arrow, drop_stored, release, shuffle_partitions, stored
from lumisort.llm.graph import components

BITS, BAND_ROWS, BANDS = 8, 4, 32
HASHES = BAND_ROWS * BANDS
WORDS64 = HASHES // 64
FINE = 512  # hashes of the longer signatures
BLOCK_ROWS, SHARD_ROWS = 1000, 20_000
GROUP = 200
SHINGLE = 5
BATCH_BYTES = 4 << 20


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _multipliers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    return (draw.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1),
            draw.integers(0, 2**63, n, np.uint64))


class Shingles:
    """Shingle sets of texts; the hash of a word is kept while a batch lasts."""

    def __init__(self):
        import re

        import xxhash
        self.find = re.compile(rb"[^\x20\x09-\x0D]+").findall
        self.hash = xxhash.xxh3_64_intdigest
        self.words: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the 5-word shingles; of the whole if shorter."""
        if not text:
            return np.zeros(0, np.uint64)
        words = self.find(text.encode("utf-8", "replace").lower())  # bytes: A-Z only
        if not words:
            return np.zeros(0, np.uint64)
        have = self.words
        if len(have) > 150_000:
            have.clear()
        for w in set(words).difference(have):
            have[w] = self.hash(w)
        h = np.fromiter(map(have.__getitem__, words), np.uint64, len(words))
        k = min(SHINGLE, len(h))
        n = len(h) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
        return np.unique(_mix(out))


def signatures(sets: list[np.ndarray], hashes: int = HASHES, seed: int = 20) -> np.ndarray:
    """uint8[documents, hashes]: low bits of each minimum (BITS = 8); zeros for empty sets."""
    out = np.zeros((len(sets), hashes), np.uint8)
    mult, add = _multipliers(hashes, seed)
    i = 0
    full = [k for k, s in enumerate(sets) if len(s)]
    while i < len(full):
        j, n = i, 0
        while j < len(full) and (j == i or n + len(sets[full[j]]) <= 32_768):  # stays in the processor's cache
            n += len(sets[full[j]])
            j += 1
        part = full[i:j]
        h = np.concatenate([sets[k] for k in part])
        start = np.cumsum([0] + [len(sets[k]) for k in part[:-1]])
        low = np.empty((len(part), hashes), np.uint64)
        for f in range(hashes):
            low[:, f] = np.minimum.reduceat(h * mult[f] + add[f], start)
        out[part] = (low & np.uint64(0xFF)).astype(np.uint8)
        i = j
    return out


def _planes(sig: np.ndarray) -> np.ndarray:
    """int64[documents, BITS * hashes / 64]: bit p of all values, side by side, for each p."""
    bits = np.unpackbits(sig[:, :, None], axis=2, bitorder="little")  # documents, hashes, bits
    packed = np.packbits(bits.transpose(0, 2, 1).reshape(len(sig), -1), axis=1, bitorder="little")
    return packed.view(np.int64).reshape(len(sig), BITS * sig.shape[1] // 64)


def _bands(sig: np.ndarray) -> np.ndarray:
    """int64[documents, BANDS]: the band's number and its values."""
    values = sig.reshape(len(sig), BANDS, BAND_ROWS).astype(np.int64)
    key = np.zeros((len(sig), BANDS), np.int64)
    for r in range(BAND_ROWS):
        key = (key << BITS) | values[:, :, r]
    return key | (np.arange(BANDS, dtype=np.int64) << (BITS * BAND_ROWS))


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, f1, f2, planes, bands) per row; f1 and f2 identify the set."""
    bound_arrow(df.sparkSession, BATCH_BYTES)
    id_type = df.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for b in batches:
            sets = [shingles.of(x) for x in b.column(1).to_pylist()]
            sig = signatures(sets)
            f1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            f2 = np.array([_mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets],
                          np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1), pa.array(f2),
                 pa.FixedSizeListArray.from_arrays(pa.array(_planes(sig).ravel()), BITS * WORDS64).cast(
                     pa.list_(pa.int64())),
                 pa.FixedSizeListArray.from_arrays(pa.array(_bands(sig).ravel()), BANDS).cast(pa.list_(pa.int64()))],
                ["id", "n_shingles", "f1", "f2", "planes", "bands"])

    return df.select(id_col, text_col).mapInArrow(
        rows, f"id {id_type}, n_shingles bigint, f1 bigint, f2 bigint, planes array<bigint>, bands array<bigint>")


def estimate(x: Column, y: Column) -> Column:
    """Collision-corrected similarity from bit counts of two plane arrays."""
    equal = F.lit(0)
    for w in range(WORDS64):
        differ = reduce(lambda p, q: p.bitwiseOR(q),
                        [F.get(x, F.lit(p * WORDS64 + w)).bitwiseXOR(F.get(y, F.lit(p * WORDS64 + w)))
                         for p in range(BITS)])
        equal = equal + (F.lit(64) - F.bit_count(differ))
    chance = 2.0 ** -BITS
    return (equal / float(HASHES) - chance) / (1.0 - chance)


def least_estimate(threshold: float, sigmas: float, hashes: int) -> float:
    return threshold - sigmas * (threshold * (1 - threshold) / hashes) ** 0.5


def most_similar(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """For each x of the pairs (x, y) the y with the best estimate, if that is ``least`` or more."""
    planes = reps.select("id", "planes")
    both = pairs.join(planes.toDF("x", "px"), "x").join(planes.toDF("y", "py"), "y")
    guess = both.select("x", "y", estimate(F.col("px"), F.col("py")).alias("e")).where(F.col("e") >= least)
    return guess.groupBy("x").agg(F.max_by("y", "e").alias("y"))


def fine_sketches(texts: DataFrame) -> DataFrame:
    """(id, sketch): signatures of FINE hashes as bit planes."""
    id_type = texts.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for b in batches:
            planes = _planes(signatures([shingles.of(x) for x in b.column(1).to_pylist()], FINE, 21))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p.tobytes() for p in planes], pa.binary())],
                                             ["id", "sketch"])

    return texts.select("id", "text").mapInArrow(rows, f"id {id_type}, sketch binary")


def across(named: DataFrame, sketch: DataFrame, reps: DataFrame, least: float, best_only: bool) -> DataFrame:
    """Pairs (x, y, e) of open buckets: x outside the bucket's largest component, y in
    another component than x, estimate at least ``least``.  If ``best_only`` the best of
    each x and block; else all, each from the first band that its two ends share.
    ``named``: (band, x, c)."""
    spark = named.sparkSession
    sizes = named.groupBy("band", "c").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("band").agg(F.max(F.struct("k", "c")).alias("m"), F.sum("k").alias("n"),
                                     F.count(F.lit(1)).alias("parts")).where(F.col("parts") > 1)
    blocks = main.select("band", F.col("m.c").alias("main"),
                         F.ceil((F.col("n") - F.col("m.k")) / float(BLOCK_ROWS)).alias("lefts"),
                         F.ceil(F.col("n") / float(BLOCK_ROWS)).alias("rights"))
    keys = reps.select(F.col("id").alias("x"), (F.lit(None).cast("array<bigint>") if best_only else F.col("bands"))
                       .alias("bands"))
    rows = named.join(blocks, "band").join(sketch.withColumnRenamed("id", "x"), "x").join(keys, "x")
    shards = max(shuffle_partitions(spark), -(-named.count() // SHARD_ROWS))
    small = (F.col("lefts") == 1) & (F.col("rights") == 1)
    h = F.xxhash64("x", "band")

    def dealt(left: bool) -> DataFrame:
        own, other = ("lefts", "rights") if left else ("rights", "lefts")
        some = rows.where(F.col("c") != F.col("main")) if left else rows
        some = some.withColumn("own", F.pmod(h, F.col(own))).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)))
        return some.select(F.when(small, F.pmod(F.xxhash64("band"), F.lit(shards))).otherwise(F.col("band")).alias("g"),
                           F.when(small, F.lit(-1).cast("bigint")).otherwise(F.col("own" if left else "other")).alias("i"),
                           F.when(small, F.lit(-1).cast("bigint")).otherwise(F.col("other" if left else "own")).alias("j"),
                           "band", F.lit(left).alias("left"), "x", "c", "sketch", "bands")

    kind = to_arrow_type(named.schema["x"].dataType)
    chance = 2.0 ** -BITS

    def compare(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("band").to_numpy(), kind="stable")
        band, left = t.column("band").to_numpy()[order], t.column("left").to_numpy()[order]
        x, c = t.column("x").to_numpy()[order], t.column("c").to_numpy()[order]
        planes = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint64).reshape(len(x), BITS, -1)[order]
        if not best_only:
            bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(x), -1)[order]
        cut = np.flatnonzero(band[1:] != band[:-1]) + 1
        out = [[], [], []]
        for rows_ in np.split(np.arange(len(x)), cut):
            a, b = rows_[left[rows_]], rows_[~left[rows_]]
            if not len(a) or not len(b):
                continue
            agree = np.zeros((len(a), len(b)), np.int32)
            for w in range(planes.shape[2]):
                differ = np.zeros((len(a), len(b)), np.uint64)
                for p in range(BITS):
                    differ |= planes[a, p, w][:, None] ^ planes[b, p, w][None]
                agree += 64 - np.bitwise_count(differ).astype(np.int32)
            e = (agree / FINE - chance) / (1 - chance)
            e[(c[a][:, None] == c[b][None]) | (e < least)] = -1
            if best_only:
                j = e.argmax(axis=1)
                i = np.flatnonzero(e[np.arange(len(a)), j] > 0)
                j = j[i]
            else:
                i, j = np.nonzero(e > 0)
                shared = (bands[a[i]] == bands[b[j]]).argmax(axis=1)  # they share this band at least
                here = bands[a[i], shared] == band[rows_[0]]
                i, j = i[here], j[here]
            for o, v in zip(out, (x[a[i]], x[b[j]], e[i, j])):
                o.append(v)
        cols = [np.concatenate(o) if o else np.zeros(0) for o in out]
        return pa.table([pa.array(cols[0].astype(x.dtype), kind), pa.array(cols[1].astype(x.dtype), kind),
                         pa.array(cols[2], pa.float64())], ["x", "y", "e"])

    id_type = named.schema["x"].dataType.simpleString()
    return (dealt(True).unionByName(dealt(False)).groupBy("g", "i", "j")
            .applyInArrow(compare, f"x {id_type}, y {id_type}, e double"))


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) with 100 * intersection >= ``percent`` * union of their full sets, stored.
    ``texts``: (id, text).  y's text goes to every salted group of y's pairs."""
    pairs = stored(pairs, "near-pairs")
    groups = pairs.groupBy("y").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(GROUP))).cast("int").alias("salts"))
    members = (pairs.join(groups, "y").select("x", "y", F.pmod(F.xxhash64("x"), F.col("salts")).cast("int")
                                              .alias("salt")))
    sent = (members.join(texts.toDF("x", "text"), "x").select("y", "salt", "x", "text")
            .unionByName(groups.join(texts.toDF("y", "text"), "y")
                         .select("y", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                                 F.col("y").alias("x"), "text")))
    id_type = pairs.schema["x"].dataType.simpleString()

    def check(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        leader, sets = key[0].as_py(), {}
        for b in batches:
            for x, text in zip(b.column("x").to_pylist(), b.column("text").to_pylist()):
                sets[x] = shingles.of(text)
        own = sets.pop(leader)
        near = []
        for x, s in sets.items():
            both = len(np.intersect1d(s, own, assume_unique=True))
            if 100 * both >= percent * (len(s) + len(own) - both) > 0:
                near.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(near, kind), pa.array([leader] * len(near), kind)], ["x", "y"])

    kind = to_arrow_type(pairs.schema["x"].dataType)
    links = stored(sent.groupBy("y", "salt").applyInArrow(check, f"x {id_type}, y {id_type}"), "links")
    drop_stored(pairs)
    return links


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """Components (x, c) after more links, worked out between components only."""
    ends = links.join(label.toDF("x", "cx"), "x", "left").join(label.toDF("y", "cy"), "y", "left").select(
        "x", "y", F.coalesce("cx", "x").alias("cx"), F.coalesce("cy", "y").alias("cy"))
    ends = stored(ends, "component-links")
    merged = stored(components(ends, "cx", "cy").toDF("c", "m"), "merged-components")
    new = ends.select("x", F.col("cx").alias("c")).union(ends.select("y", "cy")).distinct()
    every = label.unionByName(new.join(label, "x", "left_anti"))
    out = stored(every.join(merged, "c", "left").select("x", F.coalesce("m", "c").alias("c")), "components")
    drop_stored(ends, merged)
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    sigmas: float = 4.5) -> DataFrame:
    """(id, n_shingles, component_id, kept), a row per row of ``df``."""
    rows = stored(sketches(df, id_col, text_col), "sketches")
    full = rows.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    same = ["f1", "f2", "n_shingles"]
    classes = full.groupBy(*same).agg(F.min("id").alias("rep"))
    reps = stored(full.join(classes, same).where(F.col("id") == F.col("rep")).select("id", "planes", "bands")
                  .dropDuplicates(["id", "bands"]), "classes")
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    member = reps.select("id", F.explode("bands").alias("band"))
    lead = (member.groupBy("band").agg(F.min("id").alias("y"), F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select("band", "y"))
    bucket = stored(member.join(lead, "band").select("band", F.col("id").alias("x"), "y"), "buckets")
    likely = stored(texts.join(bucket.select(F.col("x").alias("id")).distinct(), "id", "left_semi")
                    .dropDuplicates(["id"]), "likely-texts")
    threshold = percent / 100
    first = most_similar(bucket.where(F.col("x") != F.col("y")).select("x", "y").distinct(), reps,
                         least_estimate(threshold, sigmas, HASHES))
    links = confirmed(first, likely, percent)
    label = stored(components(links, "x", "y").toDF("x", "c"), "components")
    drop_stored(links)
    release(df.sparkSession)  # of dozens of small plans

    # buckets that still hold more than one component
    sketch, least = None, least_estimate(threshold, sigmas, FINE)
    for best_only in (True, True, False):
        named = (bucket.select("band", "x").join(label, "x", "left")
                 .select("band", "x", F.coalesce("c", "x").alias("c")))
        several = (named.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                   .where(F.col("lo") != F.col("hi")).select("band"))
        named = stored(named.join(several, "band", "left_semi"), "open-buckets")
        if sketch is None:
            open_ids = named.select(F.col("x").alias("id")).distinct()
            sketch = stored(fine_sketches(likely.join(open_ids, "id", "left_semi")), "fine-sketches")
        pairs = across(named, sketch, reps, least, best_only)
        if best_only:
            pairs = pairs.groupBy("x").agg(F.max_by("y", "e").alias("y"))
        else:
            pairs = pairs.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
        links = confirmed(pairs, likely, percent)
        if links.limit(1).count():
            old, label = label, _joined(label, links)
            drop_stored(old)
        drop_stored(links, named)
        release(df.sparkSession)
    drop_stored(reps, bucket, likely, sketch)

    by_id = (full.select("id", *same).join(classes, same).select("id", "rep")
             .join(label.toDF("rep", "c"), "rep", "left").groupBy("id")
             .agg(F.min(F.coalesce("c", "rep")).alias("component_id")))
    out = rows.select("id", "n_shingles").join(by_id, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
