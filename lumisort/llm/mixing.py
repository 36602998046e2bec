"""Mixing documents to target weights by soft domain membership.

A classifier learned from a labelled table gives every document a posterior over
the domains; documents without a label, or that belong to several domains, count
in parts.  Nonnegative document rates are then fitted so that the expected tokens
of each domain match targets: with posteriors p_i, tokens t_i and rates r_i,

    minimise  sum_d ((sum_i r_i t_i p_id - T_d) / T)^2 + ridge * sum_i t_i (r_i - 1)^2 / T

over r >= 0 by accelerated projected gradients (``descend_rates``).  Every document keeps its
rate; a step is one partial aggregate of the domains' totals, after which each document moves
its rate down its own slope and back to 0 where it falls below.  The step length follows from
the largest curvature, known from one aggregate of second moments; the momentum starts anew
where it points uphill.  Rates are written to the shared folder every few steps.  The descent
ends when the last step proves the objective to be within ``tolerance`` of its minimum.  What
the ridge keeps the totals off their targets is in the report; gaps above 1 % are logged.

``fit_rates`` looks for the same minimum by Newton steps on its dual (r_i = max(0, 1 - p_i . g) with
one number g_d per domain); no query uses it.

Targets are weights (parts of all tokens).  The total T is what the domain with the
largest weight can fill once, times ``stretch``, unless the caller gives one: its
documents get rates near 1, and a domain too scarce for its part asks for repetition
by rates above 1 instead of pulling everything else down.

The classifier is softmax regression on hashed distinct words (unit-length idf
vectors), learned from a sample of at most about ``rows_per_label`` labelled
documents of each domain, drawn by a hash of the id; weights bring the labelled
table's shares back.  The model has ``domains * buckets`` numbers.

Null text has no tokens: its posterior is that of no words and its rate what that
gives, with no effect on totals.  Labels that are null or fit several documents of one id
count as they come; ids without a label are not learned from.  With no labelled
text every document has rate 1.  Rows that repeat are separate documents.
"""

from __future__ import annotations

import logging
import pickle
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisort.llm.common import WORD_RE, bound_arrow, drop_stored, packed, stored

LOG = logging.getLogger(__name__)
BUCKETS = 1 << 16
BATCH_BYTES = 4 << 20
ROWS_PER_FILE = 500_000


@dataclass
class Domains:
    names: list[str]
    bias: np.ndarray  # domains
    weight: np.ndarray  # buckets x domains
    idf: np.ndarray  # buckets

    def posterior(self, at: np.ndarray) -> np.ndarray:
        """Posterior of a text from its distinct buckets."""
        v = self.idf[at]
        z = self.bias + (v[:, None] * self.weight[at]).sum(axis=0) / max(float(np.sqrt((v * v).sum())), 1e-12)
        z = np.exp(z - z.max())
        return z / z.sum()


class _Hashed:
    """Word -> bucket, kept while a batch lasts."""

    def __init__(self):
        import xxhash
        self.hash = xxhash.xxh32_intdigest
        self.known: dict[str, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = WORD_RE.findall(text) if text else []
        if len(self.known) > 150_000:
            self.known.clear()
        for w in set(words).difference(self.known):
            self.known[w] = self.hash(w.encode("utf-8", "replace")) % BUCKETS
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def fit_softmax(rows: np.ndarray, at: np.ndarray, label: np.ndarray, importance: np.ndarray, names: list[str],
                steps: int = 80, penalty: float = 2e-5) -> Domains:
    """Softmax regression on unit-length idf vectors (Adam on the whole sample).
    ``at``: distinct buckets of all texts; ``rows``: how many each text has."""
    n, k = len(rows), len(names)
    idf = np.log((n + 1) / (np.bincount(at, minlength=BUCKETS) + 1)) + 0.1
    of = np.repeat(np.arange(n), rows)
    v = idf[at]
    v = v / np.sqrt(np.bincount(of, weights=v * v, minlength=n))[of]
    target = np.eye(k)[label]
    importance = importance / importance.sum()
    w, bias = np.zeros((BUCKETS, k)), np.log(importance @ target)
    m, s = np.zeros_like(w), np.zeros_like(w)
    mb, sb = np.zeros(k), np.zeros(k)
    for step in range(1, steps + 1):
        z = np.stack([np.bincount(of, weights=w[at, c] * v, minlength=n) for c in range(k)], 1) + bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        error = (z / z.sum(axis=1, keepdims=True) - target) * importance[:, None]
        grad = np.stack([np.bincount(at, weights=error[of, c] * v, minlength=BUCKETS) for c in range(k)], 1) + penalty * w
        grad_b = error.sum(axis=0)
        m, s = 0.9 * m + 0.1 * grad, 0.98 * s + 0.02 * grad ** 2
        mb, sb = 0.9 * mb + 0.1 * grad_b, 0.98 * sb + 0.02 * grad_b ** 2
        fix1, fix2, rate = 1 - 0.9 ** step, 1 - 0.98 ** step, 0.5 * (1 - 0.9 * step / steps)
        w -= rate * (m / fix1) / (np.sqrt(s / fix2) + 1e-9)
        bias -= 0.1 * rate * (mb / fix1) / (np.sqrt(sb / fix2) + 1e-9)
    return Domains(names, bias, w, idf)


def learn_domains(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  domain_col: str = "domain", rows_per_label: int = 1500) -> Domains:
    """Softmax regression over hashed words. ``labels``: (id, domain)."""
    bound_arrow(docs.sparkSession, BATCH_BYTES)
    known = labels.select(F.col(id_col).alias("_id"), F.col(domain_col).cast("string").alias("domain")).dropna()
    sizes = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.lit(0)
    for name, n in sizes.items():
        part = F.when(F.col("domain") == name, F.lit(round(1e6 * min(1.0, rows_per_label / n)))).otherwise(part)
    # labels are thinned before the join to about rows_per_label a domain: a proven
    # bound, so they go to the texts and no text moves that isn't in the sample
    known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < part)
    train = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
             .join(F.broadcast(known), "_id").select("text", "domain"))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashed()
        for b in batches:
            at = [np.unique(hashed.of(x)).astype(np.int32) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(at, pa.list_(pa.int32()))], ["domain", "at"])

    got = train.mapInArrow(buckets, "domain string, at array<int>").where(F.size("at") > 0).toArrow()
    names = sorted(set(got.column("domain").to_pylist()))
    if not names:
        return Domains([], np.zeros(0), np.zeros((BUCKETS, 0)), np.zeros(BUCKETS))
    label = np.array([names.index(x) for x in got.column("domain").to_pylist()])
    lists = got.column("at").combine_chunks()
    # the sample has equal parts of each domain; importance brings the table's shares back
    per = np.array([sizes[x] for x in names]) / np.maximum(np.bincount(label, minlength=len(names)), 1)
    return fit_softmax(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
                       lists.flatten().to_numpy(), label, per[label], names)


def posteriors(df: DataFrame, model: Domains, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens, posterior array<double>), a row per row of ``df``."""
    bound_arrow(df.sparkSession, BATCH_BYTES)
    shared = df.sparkSession.sparkContext.broadcast(packed(model))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, hashed = pickle.loads(shared.value), _Hashed()
        for b in batches:
            tokens, out = [], []
            for text in b.column(1).to_pylist():
                at = hashed.of(text)
                tokens.append(len(at))
                out.append(m.posterior(np.unique(at)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(tokens, pa.int64()), pa.array(out, pa.list_(pa.float64()))],
                [id_col, "tokens", "posterior"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(rows, f"`{id_col}` {kind}, tokens bigint, posterior array<double>")


def _rate(posterior: Column, g: np.ndarray) -> Column:
    """max(0, 1 - posterior . g)"""
    dot = reduce(lambda x, y: x + y, [F.get(posterior, F.lit(d)) * F.lit(float(x)) for d, x in enumerate(g)])
    return F.greatest(F.lit(0.0), F.lit(1.0) - dot)


def _report(names: list[str], goal: np.ndarray, now: np.ndarray, steps: int) -> dict:
    report = {"targets": dict(zip(names, goal.tolist())), "expected": dict(zip(names, now.tolist())), "steps": steps}
    if (np.abs(now - goal) > 0.01 * goal).any():
        LOG.warning("rates: expected totals more than 1 %% from the targets: %s", report)
    return report


def descend_rates(members: DataFrame, names: list[str], targets: Mapping[str, float], total: float | None = None,
                  stretch: float = 1.0, ridge: float = 1e-3, steps: int = 1000, tolerance: float = 1e-4,
                  store_every: int = 8) -> tuple[DataFrame, dict]:
    """(``members`` with ``rate``, report) by accelerated projected gradients.  ``members`` has tokens and posterior.
    ``steps`` bounds the descent, ``tolerance`` its distance from the minimum as a part of the objective;
    ``store_every``: steps between two writes of the rates."""
    k = len(names)
    weight = np.array([float(targets.get(d, 0.0)) for d in names])
    nothing = {"targets": {}, "expected": {}, "steps": 0}
    if not k or weight.sum() <= 0:
        return members.withColumn("rate", F.lit(1.0)), nothing
    weight = weight / weight.sum()
    post, t = F.col("posterior"), F.col("tokens").cast("double")

    def per_domain(rate: Column) -> list[Column]:
        return [F.sum(rate * t * F.get(post, F.lit(d))) for d in range(k)]

    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    first = members.select(F.count(F.lit(1)), F.sum(t), *per_domain(F.lit(1.0)),
                           *[F.sum(t * F.get(post, F.lit(a)) * F.get(post, F.lit(b))) for a, b in pairs]).first()
    rows, now = int(first[0]), np.array([x or 0.0 for x in first[2:2 + k]])
    most = int(weight.argmax())
    whole = float(total) if total else stretch * float(now[most] / weight[most])
    if now.sum() <= 0 or whole <= 0:
        return members.withColumn("rate", F.lit(1.0)), nothing
    goal = weight * whole
    moments = np.zeros((k, k))
    for (a, b), x in zip(pairs, first[2 + k:]):
        moments[a, b] = moments[b, a] = (x or 0.0) / whole
    steepest = float(np.linalg.eigvalsh(moments).max()) + ridge

    # narrow rows in few files: a step should cost what its rows cost
    files = max(1, -(-rows // ROWS_PER_FILE))
    kept = state = stored(members.select("*", F.lit(1.0).alias("rate"), F.lit(1.0).alias("before")).coalesce(files), "rates")
    before, pace, push, taken = now, 1.0, 0.0, 0
    path: list[tuple[np.ndarray, float]] = []  # steps since the rates were written
    for taken in range(1, steps + 1):
        # from a point ahead of the rates; totals are linear in them
        path.append(((now + push * (now - before) - goal) / whole, push))
        got = (state.select("tokens", "posterior", "rate", "before").mapInArrow(_sums(path, steepest, ridge), "s array<double>")
               .select(*[F.sum(F.get("s", F.lit(c))) for c in range(k + 3)]).first())
        before, now = now, np.array(got[:k])
        if taken % store_every == 0:
            state = stored(state.mapInArrow(_moved(path, steepest, ridge), state.schema), "rates")
            drop_stored(kept)
            kept, path = state, []
        # the objective is as curved as its ridge at least, so the last step bounds how far it is from the minimum
        objective = (((now - goal) / whole) ** 2).sum() / 2 + ridge / 2 * got[k + 1] / whole
        if steepest ** 2 * got[k] / whole / (2 * ridge) <= tolerance * objective:
            break
        pace = 1.0 if got[k + 2] > 0 else pace  # the momentum points uphill: start it anew
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        push, pace = (pace - 1) / faster, faster
    else:
        LOG.warning("rates: not at the minimum after %d steps", steps)
    out = stored(state.mapInArrow(_moved(path, steepest, ridge), state.schema).drop("before"), "rates")
    drop_stored(kept)
    return out, _report(names, goal, now, taken)


def _walk(b: pa.RecordBatch, path: list[tuple[np.ndarray, float]], steepest: float, ridge: float):
    """(tokens, posteriors, rate, rate before, point ahead of it) of a batch after the steps of ``path``."""
    t = b.column("tokens").to_numpy(zero_copy_only=False).astype(float)
    p = b.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)
    rate, before = (b.column(c).to_numpy(zero_copy_only=False) for c in ("rate", "before"))
    ahead = rate
    for off, push in path:
        ahead = rate + push * (rate - before)
        rate, before = np.maximum(0.0, ahead - (p @ off + ridge * (ahead - 1)) / steepest), rate
    return t, p, rate, before, ahead


def _sums(path, steepest: float, ridge: float):
    """Of each task: the domains' totals, and the sums that tell how far the last step went and where."""
    path = list(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = 0.0
        for b in batches:
            if b.num_rows:
                t, p, rate, before, ahead = _walk(b, path, steepest, ridge)
                moved = ahead - rate
                whole = whole + np.array([*((t * rate) @ p), t @ (moved * moved), t @ (rate - 1) ** 2, t @ (moved * (rate - before))])
        if isinstance(whole, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([whole.tolist()], pa.list_(pa.float64()))], ["s"])
    return run


def _moved(path, steepest: float, ridge: float):
    """The rows with their rates after the steps of ``path``."""
    path = list(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, _, rate, before, _ = _walk(b, path, steepest, ridge)
                new = {"rate": pa.array(rate), "before": pa.array(before)}
                yield pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in b.schema.names], names=b.schema.names)
    return run


def fit_rates(members: DataFrame, names: list[str], targets: Mapping[str, float], total: float | None = None,
              stretch: float = 1.0, ridge: float = 1e-3, steps: int = 25, tolerance: float = 1e-6) -> tuple[Column, dict]:
    """(rate as a column over ``members``, report).  ``members`` has tokens and posterior.
    ``steps`` bounds the aggregates; the fit ends when the condition of the minimum holds
    to ``tolerance`` of every target (of the smallest positive one where that is 0)."""
    k = len(names)
    weight = np.array([float(targets.get(d, 0.0)) for d in names])
    if not k or weight.sum() <= 0:
        return F.lit(1.0), {"targets": {}, "expected": {}, "steps": 0}
    weight = weight / weight.sum()
    post, t = F.col("posterior"), F.col("tokens").cast("double")
    pairs = [(a, b) for a in range(k) for b in range(a, k)]

    def totals(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens of the domains; second moments over documents with a rate above 0."""
        rated = members.select(post, t.alias("tokens"), _rate(post, g).alias("rate"))
        on = F.when(F.col("rate") > 0, F.col("tokens")).otherwise(F.lit(0.0))
        got = [x or 0.0 for x in rated.select(
            *[F.sum(F.col("rate") * F.col("tokens") * F.get(post, F.lit(d))).alias(f"d{d}") for d in range(k)],
            *[F.sum(on * F.get(post, F.lit(a)) * F.get(post, F.lit(b))).alias(f"m{a}_{b}") for a, b in pairs]).first()]
        moments = np.zeros((k, k))
        for (a, b), x in zip(pairs, got[k:]):
            moments[a, b] = moments[b, a] = x
        return np.array(got[:k]), moments

    g = np.zeros(k)
    now, moments = totals(g)
    if now.sum() <= 0:
        return F.lit(1.0), {"targets": {}, "expected": {}, "steps": 0}
    most = int(weight.argmax())
    whole = float(total) if total else stretch * float(now[most] / weight[most])
    if whole <= 0:
        return F.lit(1.0), {"targets": {}, "expected": {}, "steps": 0}
    goal = weight * whole
    close = tolerance * np.where(goal > 0, goal, goal[goal > 0].min())
    off = now - goal  # of g = 0; the dual is convex, and its gradient is -off
    taken, size, step = 0, 1.0, np.zeros(k)
    while (np.abs(off) > close).any() and taken < steps:
        if size == 1.0:
            step = np.linalg.solve(moments + whole * ridge * np.eye(k), off)
            slope = float(off @ step)
        at = g + size * step
        now_at, moments_at = totals(at)
        off_at = now_at - goal - whole * ridge * at
        taken += 1
        # along a Newton step the slope falls from ``slope`` to 0 or past it; a step that
        # goes so far past it that the slope grows is halved
        if abs(float(off_at @ step)) > 0.9 * slope and size > 1e-3:
            size /= 2
            continue
        g, now, moments, off, size = at, now_at, moments_at, off_at, 1.0
    if (np.abs(off) > close).any():
        LOG.warning("rates: not converged after %d steps, off by %s of the targets", taken,
                    dict(zip(names, (off / np.maximum(goal, 1e-300)).tolist())))
    return _rate(post, g), _report(names, goal, now, taken)


def mixing_rates(df: DataFrame, labels: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id",
                 text_col: str = "text", domain_col: str = "domain", total: float | None = None,
                 stretch: float = 1.0, **learning) -> tuple[DataFrame, dict]:
    """((id, tokens, posterior, rate), report), a row per row of ``df``."""
    model = learn_domains(df, labels, id_col, text_col, domain_col, **learning)
    if not model.names:
        return (df.select(id_col, F.lit(0).cast("bigint").alias("tokens"),
                          F.array().cast("array<double>").alias("posterior"), F.lit(1.0).alias("rate")),
                {"targets": {}, "expected": {}, "steps": 0})
    members = stored(posteriors(df, model, id_col, text_col), "posteriors")
    rated, report = descend_rates(members, model.names, targets, total, stretch)
    if getattr(rated, "_stored_at", None):
        drop_stored(members)
    return rated, report | {"domains": model.names}
