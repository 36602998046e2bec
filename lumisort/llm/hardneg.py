"""Hard-negative mining by angular triangle filtering.

Vectors become integers (``floor(scale * x)``); a score is an integer inner product.  For
each anchor the best rows of its label are its positives, and for each positive the best
rows of other labels whose score is within a band of the positive's are its negatives.

1. Rows of equal integer vector and label score alike, so they become one *point* with its
   smallest ids (as many as any answer can use): copies of one vector, however many, are
   one point.  Anchors of one vector and label become one *class* the same way.
2. Reference directions come from a bounded sample (``sample_rows``) by farthest-first
   choice.  Each point is stored with its norm and its angles to them, sorted by label,
   nearest reference and angle.
3. Points are streamed past batches of anchor classes (``anchor_bytes`` each, broadcast).
   With angles a and v to a reference, the angle between anchor and point lies within
   [|a - v|, min(a + v, 2 pi - a - v)]; the tightest interval over all references, times both
   norms and rounded outwards, bounds the score.  First whole tiles of points are held against
   an anchor's window, then single points; only those that overlap it are scored in
   integers.  The window's lower end rises as better rows are found.
4. Each task returns its best few per anchor; they are merged per class, and classes are
   joined back to the anchors.

All rows are points and all anchors are asked; references only steer what is skipped.

Defined results: rows with a null id, label or vector or a null or non-finite component, or
with one whose integer reaches 2^62, take no part.  Rows that repeat id, label and vector
count once; another vector under the anchor's id is another row.  Only vectors of equal
length are compared (those of another length than the sample's commonest without angles,
by scoring alone).  Zero vectors score 0.  Scores beyond 64 bits are compared exactly and
reported as the largest 64-bit number.  Ties go to the smaller id.  An anchor without positives or
negatives has no rows; empty tables give empty results.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumisort.llm.common import attach_groups, bound_arrow, drop_stored, shuffle_partitions, stored

TILE = 256
SLACK = 1e-6  # radians; angles are right to some 2e-8
FOUND = "cls int, win int, id long, score long, own boolean"
_EDGE = 1 << 62  # beyond any score of the 64-bit path
_FAR = 1 << 200  # beyond any score


# ------------------------------------------------------------------ geometry

def reference_directions(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` unit vectors of the sample (rows), each the farthest from those before."""
    norm = np.linalg.norm(sample, axis=1)
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1] if sample.ndim == 2 else 0))
    mean = unit.mean(axis=0)
    chosen = [int(np.argmax(unit @ mean))]
    near = unit @ unit[chosen[0]]
    while len(chosen) < min(count, len(unit)):
        k = int(np.argmin(near))
        if near[k] > 1 - 1e-9:
            break
        chosen.append(k)
        near = np.maximum(near, unit @ unit[k])
    return unit[chosen]


def angles_to(refs: np.ndarray, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Angles of the rows of ``q`` to the references; zero vectors have angle 0 (their scores are 0)."""
    cos = q @ refs.T / np.where(norm > 0, norm, 1)[:, None]
    return np.where(norm[:, None] > 0, np.arccos(np.clip(cos, -1, 1)), 0.0)


def score_bounds(least: np.ndarray, most: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of scores whose angle lies within [least, most]; rounded outwards."""
    slack = norms * 1e-9 + 1
    low = norms * np.cos(np.minimum(most + SLACK, math.pi)) - slack
    high = norms * np.cos(np.maximum(least - SLACK, 0)) + slack
    return low, high


def _between(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible angle between anchors (angles ``a``) and points whose angles lie within
    [lo, hi], a matrix anchors x points (or tiles): tightest over the references."""
    least = np.zeros((len(a), len(lo)))
    most = np.full((len(a), len(lo)), math.pi)
    for r in range(a.shape[1]):
        x, l, h = a[:, r, None], lo[None, :, r], hi[None, :, r]
        np.maximum(least, np.maximum(l - x, x - h), out=least)
        np.minimum(most, np.minimum(x + h, 2 * math.pi - x - l), out=most)
    return least, most


# ------------------------------------------------------------------ scanning

class Best:
    """The first ``k`` of each group by (score descending, id)."""

    def __init__(self, groups: int, k: int, exact: bool):
        self.k, self.floor = k, np.full(groups, -_FAR if exact else -_EDGE, dtype=object if exact else np.int64)
        self.rows = [np.zeros(0, np.int64), np.zeros(0, self.floor.dtype), np.zeros(0, np.int64), np.zeros(0, bool)]
        self.waiting, self.size = [], 0

    def add(self, group, score, ids, own):
        self.waiting.append((group, score.astype(self.floor.dtype), ids, own))
        self.size += len(group)
        if self.size > 20_000 + len(self.rows[0]):
            self.settle()

    def settle(self):
        if not self.waiting:
            return self.rows
        g, s, i, o = (np.concatenate(x) for x in zip(self.rows, *self.waiting))
        self.waiting, self.size = [], 0
        order = np.lexsort((i, -s, g))
        g, s, i, o = g[order], s[order], i[order], o[order]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
        rank = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
        last = rank == self.k - 1
        self.floor[g[last]] = s[last]
        keep = rank < self.k
        self.rows = [g[keep], s[keep], i[keep], o[keep]]
        return self.rows


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values) of a list column."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _blocks(batch: pa.RecordBatch) -> Iterator[dict]:
    """Points of one length and of equally many angles, as arrays."""
    sizes, flat = _lists(batch.column("q"))
    n_ang, ang = _lists(batch.column("angles"))
    n_ids, ids = _lists(batch.column("ids"))
    at, at_ang, at_ids = (np.r_[0, np.cumsum(x)] for x in (sizes, n_ang, n_ids))
    label, norm = batch.column("label").to_numpy(), batch.column("norm").to_numpy()
    for d, m in sorted(set(zip(sizes.tolist(), n_ang.tolist()))):
        rows = np.flatnonzero((sizes == d) & (n_ang == m))
        yield {"q": flat[at[rows][:, None] + np.arange(d)], "angles": ang[at_ang[rows][:, None] + np.arange(m)],
               "label": label[rows], "norm": norm[rows], "ids": [ids[at_ids[r]:at_ids[r + 1]] for r in rows]}


def _scores(a: np.ndarray, v: np.ndarray, mask: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, point, score) of the pairs in ``mask``.  Float products of integers are exact below 2^53."""
    i, j = np.nonzero(mask)
    if exact:
        return i, j, np.array([sum(x * y for x, y in zip(a[x].tolist(), v[y].tolist())) for x, y in zip(i, j)], dtype=object)
    if 16 * len(i) > mask.size:  # many pairs of the tile: one product of matrices
        return i, j, (a.astype(float) @ v.T.astype(float))[i, j].astype(np.int64)
    return i, j, np.einsum("ij,ij->i", a[i].astype(float), v[j].astype(float)).astype(np.int64)


def scan(batches, classes: list[dict], k: int, negatives: bool, stats: dict | None = None):
    """Best rows of the streamed points for all classes: (cls, win, id, score, own).

    ``classes``: blocks of anchors of one length (cls, q, label, norm, angles, lo, hi); ``lo``/``hi`` are
    the windows of the scores looked for, anchors x windows.  ``stats`` counts pairs (for tests)."""
    state = []
    for c in classes:
        n, w = c["lo"].shape
        state.append({**c, "best": Best(n * w, k, c["lo"].dtype == object), "windows": w})
    for batch in batches:
        for p in _blocks(batch):
            for c in state:
                if c["q"].shape[1] == p["q"].shape[1]:
                    for s in range(0, len(p["label"]), TILE):
                        _tile(c, {x: v[s:s + TILE] for x, v in p.items()}, negatives, stats)
    for c in state:
        g, s, i, own = c["best"].settle()
        top = (1 << 63) - 1
        s = np.array([max(-top, min(top, int(x))) for x in s], np.int64) if s.dtype == object else s
        yield pa.RecordBatch.from_arrays(
            [pa.array(c["cls"][g // c["windows"]], pa.int32()), pa.array(g % c["windows"], pa.int32()),
             pa.array(i, pa.int64()), pa.array(s, pa.int64()), pa.array(own, pa.bool_())],
            names=["cls", "win", "id", "score", "own"])


def _tile(c: dict, p: dict, negatives: bool, stats: dict | None) -> None:
    """One tile of points against one block of anchors."""
    floor = c["best"].floor.reshape(c["lo"].shape)
    low_each = np.maximum(c["lo"], floor)
    low, high = low_each.min(axis=1), c["hi"].max(axis=1)
    wanted = low <= high
    labels = np.unique(p["label"])
    if negatives:
        wanted &= (len(labels) > 1) | (c["label"] != labels[0])
    else:
        wanted &= np.isin(c["label"], labels)
    lowf, highf = low.astype(float), high.astype(float)
    m = c["angles"].shape[1] if c["angles"].shape[1] == p["angles"].shape[1] else 0
    norm = p["norm"]
    if m:
        least, most = _between(c["angles"], p["angles"].min(axis=0)[None], p["angles"].max(axis=0)[None])
        # the largest norm widens the bounds to either side unless the cosine has one sign
        lo1, hi1 = score_bounds(least[:, 0], most[:, 0], c["norm"] * norm.max())
        lo0, hi0 = score_bounds(least[:, 0], most[:, 0], c["norm"] * norm.min())
        wanted &= (np.maximum(hi0, hi1) >= lowf) & (np.minimum(lo0, lo1) <= highf)
    a = np.flatnonzero(wanted)
    if stats is not None:
        stats["pairs"] = stats.get("pairs", 0) + len(c["label"]) * len(norm)
    if not len(a):
        return
    mask = (c["label"][a][:, None] != p["label"][None]) if negatives else (c["label"][a][:, None] == p["label"][None])
    if m:
        low_b, high_b = score_bounds(*_between(c["angles"][a], p["angles"], p["angles"]), c["norm"][a][:, None] * norm[None])
        mask &= (high_b >= lowf[a][:, None]) & (low_b <= highf[a][:, None])
    exact = c["lo"].dtype == object
    if not exact and c["norm"].max() * norm.max() >= 2.0 ** 52:
        raise OverflowError("scores beyond 2^53 need exact windows")
    i, j, s = _scores(c["q"][a], p["q"], mask, exact)
    if stats is not None:
        stats["scored"] = stats.get("scored", 0) + len(i)
    copies = np.array([len(x) for x in p["ids"]])
    for w in range(c["windows"]):
        hit = (s >= low_each[a[i], w]) & (s <= c["hi"][a[i], w])
        if not hit.any():
            continue
        x, y, z = a[i[hit]], j[hit], s[hit]
        own = (c["q"][x] == p["q"][y]).all(axis=1) & (c["label"][x] == p["label"][y])
        n = copies[y]
        c["best"].add(np.repeat(x * c["windows"] + w, n), np.repeat(z, n),
                      np.concatenate([p["ids"][t] for t in y]), np.repeat(own, n))


# ------------------------------------------------------------------ the job

def _usable(rows: DataFrame, id_col: str, vec_col: str, label: Column, scale: int, anchor: Column) -> DataFrame:
    """(id, label, q, anchor) of the rows that take part, each once."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    big = float(1 << 62)
    d = rows.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), x.alias("x"),
                    F.coalesce(anchor, F.lit(False)).alias("anchor"))
    d = d.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
                & F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v * scale) < big), F.lit(False))))
    q = F.transform("x", lambda v: F.floor(v * scale).cast("bigint"))
    return d.select("id", "label", q.alias("q"), "anchor").groupBy("id", "label", "q").agg(F.max("anchor").alias("anchor"))


def _class_key() -> Column:
    text = F.concat_ws(",", F.col("label").cast("string"), F.array_join(F.transform("q", lambda v: v.cast("string")), ","))
    return F.unhex(F.md5(text))


def _with_angles(df: DataFrame, refs: np.ndarray) -> DataFrame:
    """``df`` with norm, angles and the nearest reference's number and angle."""
    fields = df.schema.simpleString()[len("struct<"):-1]
    names = df.columns

    def run(batches):
        for b in batches:
            sizes, flat = _lists(b.column("q"))
            at = np.r_[0, np.cumsum(sizes)]
            norm, angles = np.zeros(len(sizes)), [np.zeros(0)] * len(sizes)
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                q = flat[at[rows][:, None] + np.arange(d)].astype(float)
                top = np.maximum(np.abs(q).max(axis=1) if d else np.zeros(len(rows)), 1)
                norm[rows] = top * np.linalg.norm(q / top[:, None], axis=1)
                if d == refs.shape[1] and len(refs):
                    for r, x in zip(rows, angles_to(refs, q, norm[rows])):
                        angles[r] = x
            near = np.array([int(np.argmin(x)) if len(x) else -1 for x in angles], np.int32)
            tilt = np.array([x.min() if len(x) else 0.0 for x in angles])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(norm), pa.array(angles, pa.list_(pa.float64())),
                 pa.array(near, pa.int32()), pa.array(tilt)], names=[*names, "norm", "angles", "cell", "tilt"])

    return df.mapInArrow(run, fields + ",norm double,angles array<double>,cell int,tilt double")


def _anchor_blocks(rows, windows) -> list[dict]:
    """Collected classes as blocks of one length and number of angles, 512 anchors each.  ``windows``: by
    class number the list of (lo, hi), or None for all scores."""
    groups: dict = {}
    for r in rows:
        groups.setdefault((len(r["q"]), len(r["angles"])), []).append(r)
    out = []
    for (d, m), part in sorted(groups.items()):
        for s in range(0, len(part), 512):
            block = part[s:s + 512]
            spans = [windows[r["cls"]] if windows is not None else [(-_FAR, _FAR)] for r in block]
            w = max(map(len, spans))
            norm = np.array([r["norm"] for r in block])
            spans = [x + [(_FAR, -_FAR)] * (w - len(x)) for x in spans]  # empty windows where an anchor has fewer
            out.append({"cls": np.array([r["cls"] for r in block]), "norm": norm,
                        "q": np.array([r["q"] for r in block], np.int64).reshape(len(block), d),
                        "label": np.array([r["label"] for r in block]),
                        "angles": np.array([r["angles"] for r in block], float).reshape(len(block), m),
                        "lo": np.array([[x[0] for x in y] for y in spans], object),
                        "hi": np.array([[x[1] for x in y] for y in spans], object)})
    return out


def _run_scan(points: DataFrame, blocks: list[dict], k: int, negatives: bool, largest: float) -> DataFrame:
    """The best ``k`` per class and window, merged over all tasks."""
    for b in blocks:
        if b["norm"].max() * largest < 2.0 ** 52:
            # all windows that can hold a score fit 64 bits
            b["lo"], b["hi"] = (np.clip(b[x], -_EDGE, _EDGE).astype(np.int64) for x in ("lo", "hi"))
    shared = points.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        yield from scan(batches, shared.value, k, negatives)

    found = points.select("label", "q", "ids", "norm", "angles").mapInArrow(run, FOUND)
    best = Window.partitionBy("cls", "win").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label",
                   anchor: Column | None = None, n_positives: int = 5, n_negatives: int = 3,
                   band: tuple[int, int] = (50, 95), scale: int = 256, references: int = 12, sample_rows: int = 4096,
                   anchor_bytes: int = 32 << 20) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` marks the rows that are asked (default: all).  ``band``: percent of the positive's score
    that a negative's score must lie within.  ``sample_rows`` bounds what the references are chosen from,
    ``anchor_bytes`` the anchor classes that are broadcast at a time."""
    spark = rows.sparkSession
    bound_arrow(spark)
    label = F.col(label) if isinstance(label, str) else label
    asked = F.lit(True) if anchor is None else anchor
    usable = stored(_usable(rows, id_col, vec_col, label, scale, asked), "hardneg-rows")
    parts = shuffle_partitions(spark)

    # a point keeps the ids that an answer can use: positives beside the anchor itself, negatives
    most = max(n_positives + 1, n_negatives)
    first = Window.partitionBy("label", "q").orderBy("id")
    points = (usable.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= most)
              .groupBy("label", "q").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    classes = usable.where("anchor").groupBy("label", "q").agg(F.count(F.lit(1)).alias("n"))

    total = usable.count()
    share = min(1.0, 1.5 * sample_rows / max(1, total))
    sample = (usable.where(F.pmod(F.xxhash64("q"), F.lit(1 << 20)) < share * (1 << 20)).select("q").distinct()
              .limit(sample_rows).collect())
    by_size: dict = {}
    for r in sample:
        by_size.setdefault(len(r["q"]), []).append(r["q"])
    commonest = max(by_size.values(), key=lambda x: (len(x), len(x[0])), default=np.zeros((0, 1)))
    refs = reference_directions(np.array(commonest, float), references)

    points = stored(_with_angles(points, refs).repartitionByRange(parts, "label", "cell", "tilt")
                    .sortWithinPartitions("label", "cell", "tilt"), "hardneg-points")
    size = points.agg(F.max("norm").alias("m")).first()
    largest = float(size["m"] or 0.0)
    numbered = (classes.withColumn("key", _class_key()))
    numbered = stored(_with_angles(numbered, refs), "hardneg-classes")
    count = numbered.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("q") + F.size("angles")).alias("x")).first()
    batches = max(1, math.ceil(8 * int(count["x"] or 0) / anchor_bytes))

    answers = []
    for k in range(batches if count["n"] else 0):
        mine = numbered.where(F.pmod(F.xxhash64("key"), F.lit(batches)) == k)
        got = mine.select("key", "label", "q", "norm", "angles").orderBy("label", "cell", "tilt").collect()
        if not got:
            continue
        anchors = [{**r.asDict(), "cls": i} for i, r in enumerate(got)]
        best = _run_scan(points, _anchor_blocks(anchors, None), n_positives + 1, False, largest)
        positives: dict = {}
        for r in best.collect():
            positives.setdefault(r["cls"], []).append((r["rank"], r["id"], r["score"], r["own"]))
        spans = {}
        for c, found in positives.items():
            spans[c] = sorted({(-(-band[0] * s // 100), band[1] * s // 100) for _, _, s, _ in found})
        some = [a for a in anchors if any(lo <= hi for lo, hi in spans.get(a["cls"], []))]
        if not some:
            continue
        below = _run_scan(points, _anchor_blocks(some, spans), n_negatives, True, largest)
        keys = [(a["cls"], bytes(a["key"])) for a in some]
        own_ids = [[i for _, i, _, own in sorted(positives[c]) if own] for c, _ in keys]
        pos = [(c, rank, i, s, own, spans[c].index((-(-band[0] * s // 100), band[1] * s // 100)))
               for c, _ in keys for rank, i, s, own in positives[c]]
        pos = spark.createDataFrame(pos, "cls int, prank int, pid long, pscore long, own boolean, win int")
        keys = spark.createDataFrame([(*x, y) for x, y in zip(keys, own_ids)], "cls int, key binary, own_ids array<long>")
        below = below.groupBy("cls", "win").agg(F.sort_array(F.collect_list(F.struct(
            "rank", F.col("id").alias("nid"), F.col("score").alias("nscore")))).alias("negatives"))
        answer = (pos.join(below, ["cls", "win"]).join(keys, "cls").groupBy("key", "own_ids")
                  .agg(F.sort_array(F.collect_list(F.struct("prank", "pid", "pscore", "own", "negatives"))).alias("found")))
        answers.append(stored(answer, "hardneg-answers"))
    drop_stored(points)
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not answers:
        return spark.createDataFrame([], schema)
    found = reduce(DataFrame.unionByName, answers).join(numbered.select("key", "n"), "key")
    found = stored(found, "hardneg-found")
    drop_stored(*answers, numbered)
    asked = usable.where("anchor").select("id", _class_key().alias("key"), F.monotonically_increasing_id().alias("row"))
    out = attach_groups(asked, found, "key", "n", "row").where(F.col("found").isNotNull())
    # the list holds one more than asked for: the anchor's own row goes, or else the last
    own_listed = F.array_contains("own_ids", F.col("id"))
    out = out.select("id", own_listed.alias("own_listed"), F.explode("found").alias("p"))
    own = F.col("p.own") & (F.col("p.pid") == F.col("id"))
    out = out.where(~own & (F.col("own_listed") | (F.col("p.prank") <= n_positives)))
    out = out.select(F.col("id").alias("anchor_id"), "p", F.explode("p.negatives").alias("n"))
    return out.select("anchor_id", F.col("p.pid").alias("positive_id"), F.col("n.rank").alias("rank"),
                      F.col("n.nid").alias("negative_id"), F.col("p.pscore").alias("positive_score"),
                      F.col("n.nscore").alias("negative_score"))


__all__ = ["hard_negatives"]
