"""Language ID with interpolated Kneser-Ney character models.

Training (``fit``) counts character 4-grams of labelled texts on Spark (partial
counts per batch, summed per language) over a bounded sample, at most
``rows_per_language`` distinct texts of each language, taken by a hash of the text.
The counts make one interpolated Kneser-Ney model per language: raw counts at
order 4, continuation counts below, one absolute discount per order.  A gram is a
64-bit hash, 16 bits a character (exact within the basic plane); the model is a
sorted array of gram hashes with the log-probabilities of every language beside it,
plus sorted count arrays from which grams nobody saw are worked out by the same
formula.

Scoring (``predict``) looks every character of every whole text up and takes the
language with the lowest cross-entropy per character.  On labelled texts kept out
of the counts, ``fit`` calibrates a temperature, which turns entropies into the
score (the posterior of the chosen language), and per language the cross-entropy
above which a text is ``rejected`` as unlike anything learned.

Letters are lower-cased; runs of other characters count as one blank; marks belong to
the letters they stand with.  Repeated rows and copies of a text count once in training; a
language with fewer than 20 distinct texts keeps none out.  Text that is null or has no letter
(marks alone are none) gets language ``und``, score 0 and is rejected; so does
every text if nothing could be learned.  Ties go to the first language by name.
Only the id and text columns are read, so no other column can be an input.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumisort._compat import worker_cache
from lumisort.llm.common import bound_arrow, drop_stored, packed, stored

ORDER = 4
BLANK = 0x20
BATCH_BYTES = 4 << 20


def _fold_table() -> np.ndarray:
    """Code point in the basic plane -> code of its lower-case letter or mark, else blank."""
    import unicodedata
    cache = worker_cache()
    if "langid-fold" not in cache:
        table = np.full(0x10000, BLANK, np.uint16)
        for cp in range(0x10000):
            ch = chr(cp)
            kind = unicodedata.category(ch)[0]
            if kind in "LM":
                low = ch.lower()
                table[cp] = ord(low[0]) if kind == "L" and ord(low[0]) < 0x10000 else cp
        cache["langid-fold"] = table
    return cache["langid-fold"]


def letters(text: str) -> np.ndarray:
    """Folded codes (uint16): letters, single blanks between, ORDER-1 blanks before, one after; none without a letter."""
    if not any(map(str.isalpha, text)):
        return np.zeros(0, np.uint16)
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _fold_table()
    if len(cps) and cps.max() > 0xFFFF:
        import unicodedata
        code = table[np.minimum(cps, 0xFFFF)]
        for cp in np.unique(cps[cps > 0xFFFF]).tolist():
            if unicodedata.category(chr(cp))[0] in "LM":
                code[cps == cp] = (cp * 40503) & 0xFFFF | 0x8000
            else:
                code[cps == cp] = BLANK
    else:
        code = table[cps]
    blank = code == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first blank after a letter stays
    code = code[keep]
    if not len(code) or (code == BLANK).all():
        return np.zeros(0, np.uint16)
    if code[0] == BLANK:
        code = code[1:]
    tail = [] if code[-1] == BLANK else [BLANK]
    return np.concatenate([np.full(ORDER - 1, BLANK, np.uint16), code, np.array(tail, np.uint16)])


def grams(code: np.ndarray) -> np.ndarray:
    """Hash of the ORDER-gram that ends at each character after the padding."""
    c = code.astype(np.uint64)
    n = len(c) - ORDER + 1
    out = c[:n].copy()
    for k in range(1, ORDER):
        out <<= np.uint64(16)
        out |= c[k:k + n]
    return out


@dataclass
class Order:
    """Sorted gram hashes with discounted counts, sorted contexts with totals and back-off mass."""
    keys: np.ndarray
    discounted: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    mass: np.ndarray


@dataclass
class Model:
    langs: list[str] = field(default_factory=list)
    orders: list[list[Order]] = field(default_factory=list)  # [language][order - 1]
    alphabet: int = 1
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    log_p: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    temperature: float = 1.0
    limit: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def probability(self, lang: int, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """p(last character | the ones before) under the interpolated model."""
        if order == 0:
            return np.full(len(keys), 1.0 / self.alphabet)
        o = self.orders[lang][order - 1]
        lower = self.probability(lang, keys & np.uint64((1 << 16 * (order - 1)) - 1) if order > 1 else keys, order - 1)
        own = _values(o.keys, o.discounted, keys)
        context = keys >> np.uint64(16)
        total, mass = _values(o.contexts, o.total, context), _values(o.contexts, o.mass, context)
        seen = total > 0
        total = np.where(seen, total, 1.0)
        return np.where(seen, own / total + mass / total * lower, lower)

    def entropies(self, codes: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy per character, a row per text and a column per language."""
        out = np.zeros((len(codes), len(self.langs)))
        for i, code in enumerate(codes):
            if not len(code):
                continue
            keys = grams(code)
            at = np.minimum(np.searchsorted(self.known, keys), max(len(self.known) - 1, 0))
            hit = self.known[at] == keys
            if hit.all():
                total = self.log_p[at].sum(axis=0, dtype=np.float64)
            else:
                total = self.log_p[at[hit]].sum(axis=0, dtype=np.float64)
                rare, times = np.unique(keys[~hit], return_counts=True)
                for lang in range(len(self.langs)):
                    total[lang] += (np.log(self.probability(lang, rare)) * times).sum()
            out[i] = -total / len(keys)
        return out


def _values(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Value of each wanted key, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def _order(keys: np.ndarray, counts: np.ndarray) -> Order:
    """Discounted counts and context totals from sorted grams and their counts."""
    n1, n2 = int((counts == 1).sum()), int((counts == 2).sum())
    discount = min(max(n1 / (n1 + 2 * n2), 0.05), 0.95) if n1 + n2 else 0.5
    contexts, first = np.unique(keys >> np.uint64(16), return_index=True)
    total = np.add.reduceat(counts.astype(np.float64), first)
    kinds = np.diff(np.append(first, len(keys)))
    return Order(keys, counts - discount, contexts, total, discount * kinds)


def _language(keys: np.ndarray, counts: np.ndarray) -> list[Order]:
    """Orders 1 to ORDER; below the top, counts are the numbers of distinct left neighbours."""
    orders = [_order(keys, counts)]
    for n in range(ORDER - 1, 0, -1):
        keys, counts = np.unique(keys & np.uint64((1 << 16 * n) - 1), return_counts=True)
        orders.append(_order(keys, counts))
    return orders[::-1]


def build_model(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Model of {language: (sorted gram hashes, counts)}."""
    langs = sorted(counts)
    m = Model(langs, [_language(*counts[x]) for x in langs])
    if langs:
        m.alphabet = len(np.unique(np.concatenate([o[0].keys for o in m.orders]))) + 1
        m.known = np.unique(np.concatenate([counts[x][0] for x in langs]))
        m.log_p = np.stack([np.log(m.probability(i, m.known)) for i in range(len(langs))], 1).astype(np.float32)
    m.limit = np.full(len(langs), np.inf)
    return m


def _count_grams(train: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Gram counts per language of (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                code = letters(text)
                if len(code):
                    by.setdefault(lang, []).append(grams(code))
            for lang, parts in by.items():
                key, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(key), pa.string()),
                                                  "gram": pa.array(key.view(np.int64)), "n": pa.array(n)})

    rows = (train.mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    out = {}
    lang, gram, n = rows.column("lang").to_numpy(zero_copy_only=False), rows.column("gram").to_numpy(), rows.column("n").to_numpy()
    for x in sorted(set(lang.tolist())):
        own = lang == x
        key = gram[own].astype(np.int64).view(np.uint64)
        order = np.argsort(key)
        out[x] = key[order], n[own][order].astype(np.int64)
    return out


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 4000,
        calibration_share: float = 0.1, reject_quantile: float = 0.999) -> Model:
    """Model of the labelled rows of ``train`` (null text or language: not used)."""
    spark = train.sparkSession
    bound_arrow(spark, BATCH_BYTES)
    sample = _sample(train.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna(),
                     rows_per_language, calibration_share)
    model = build_model(_count_grams(sample.where(~F.col("kept_out")).select("text", "lang")))
    if len(model.langs):
        seen = predict(sample.where("kept_out"), model, "lang", "text").select("lang", "n_letters", "entropies")
        _calibrate(model, seen.collect(), reject_quantile)
    drop_stored(sample)
    return model


def _sample(rows: DataFrame, bound: int, share: float) -> DataFrame:
    """(text, lang, kept_out), written once: of each language the ``bound`` distinct texts with the smallest hashes, so
    copies of one text count once.  The first ``share`` of them are kept out of the counts if that is two or more of 20."""
    hashed = rows.select("lang", F.xxhash64("text").alias("h"))
    sizes = {r["lang"]: r["n"] for r in hashed.distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.lit(0)
    for lang, n in sizes.items():  # some more than the bound, to be cut exactly below
        part = F.when(F.col("lang") == lang, F.lit(math.ceil(1e6 * min(1.0, (1.2 * bound + 200) / n)))).otherwise(part)
    by_hash = Window.partitionBy("lang").orderBy("h")
    drawn = (hashed.where(F.pmod(F.xxhash64("h"), F.lit(1_000_000)) < part).distinct()
             .withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= bound)
             .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("lang"))))
    apart = (F.col("n") >= 20) & (F.col("rank") <= F.floor(F.col("n") * share))
    # at most ``bound`` rows a language, so texts are filtered in place
    drawn = F.broadcast(drawn.select("lang", "h", apart.alias("kept_out")))
    texts = rows.withColumn("h", F.xxhash64("text")).join(drawn, ["lang", "h"]).dropDuplicates(["lang", "h"])
    return stored(texts.select("text", "lang", "kept_out"), "langid-sample")


def _calibrate(model: Model, rows: list, quantile: float) -> None:
    """Temperature by likelihood of the labels; rejection limits by the spread of entropies."""
    place = {x: i for i, x in enumerate(model.langs)}
    rows = [r for r in rows if r["n_letters"] and r["lang"] in place]
    if not rows:
        return
    h = np.array([r["entropies"] for r in rows])
    true = np.array([place[r["lang"]] for r in rows])

    def loss(t: float) -> float:
        z = -h * t
        z -= z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), true]).mean())

    model.temperature = min((float(t) for t in np.geomspace(1, 64, 25)), key=loss)
    for i in range(len(model.langs)):
        own = h[true == i, i]
        if len(own) >= 20:
            model.limit[i] = float(np.quantile(own, quantile)) + 2 * float(own.std())


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected, entropy, n_letters, entropies), a row per row of ``df``."""
    spark = df.sparkSession
    bound_arrow(spark, BATCH_BYTES)
    shared = spark.sparkContext.broadcast(packed(model))
    id_type = df.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(shared.value)
        for b in batches:
            codes = [letters(x) if x else np.zeros(0, np.uint16) for x in b.column(1).to_pylist()]
            n = np.array([max(0, len(c) - ORDER + 1) for c in codes], np.int64)
            h = m.entropies(codes) if m.langs else np.zeros((len(codes), 1))
            known = (n > 0) & bool(m.langs)
            best = h.argmin(axis=1)
            low = h[np.arange(len(h)), best]
            score = 1.0 / np.exp(-(h - low[:, None]) * m.temperature).sum(axis=1)
            rejected = ~known | (low > (m.limit[best] if m.langs else 0))
            langs = [m.langs[k] if ok else "und" for k, ok in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(np.where(known, score, 0.0)),
                 pa.array(rejected), pa.array(low), pa.array(n), pa.array(h.tolist(), pa.list_(pa.float64()))],
                [id_col, "lang_pred", "score", "rejected", "entropy", "n_letters", "entropies"])

    return df.select(id_col, text_col).mapInArrow(
        rows, f"`{id_col}` {id_type}, lang_pred string, score double, rejected boolean, entropy double,"
              " n_letters bigint, entropies array<double>")


def fold(id_col: Column, folds: int = 4) -> Column:
    """CRC-32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))
