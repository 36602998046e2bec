"""Exact removal of long repeated byte strings with a run-length index.

Every byte that lies in a string of ``length`` bytes that also starts anywhere else,
in the same document or another, is removed; strings are judged on the input.

1. Windows of ``length`` bytes with one anchor form a range (see ``cells``).  Ranges
   are asked by anchor and bytes: an anchor nobody else has settles its windows as
   unique, equal ranges settle theirs as repeated.
2. Ranges that share an anchor but not their bytes are cut into cells and asked the
   same way by core and bytes.
3. Cells that share a core but not their bytes go, as texts of little over
   ``length`` bytes and one of each kind, to the shard of their core.  There a
   run-compressed Burrows-Wheeler transform of the shard's texts is built, with the
   places of its run heads sampled; matching statistics stream through every text
   and mark where a match of ``length`` bytes starts.
   A core with more than ``HOT`` kinds of cells would make a shard as large as its
   number of documents: the windows of such cells (a dozen each) are counted by hash
   instead, one entry per chunk and window.

Rows with null text take part as empty.  Rows that repeat are separate documents,
so each is a copy of the other.  Texts shorter than ``length`` stay whole.  Rows
without an id stay whole and do not count as copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisort.llm.cells import CELL, GRAM, Prefix, cells, ranges
from lumisort.llm.rounds import Job, run_rounds

HOT = 2000
REPEATED, MIXED, FIRST, MANY = 1, 2, 4, 8  # bits of an answer
ENTRIES, PIECES, WINDOWS = 0, 1, 2  # kinds of questions


class RunLengthIndex:
    """Run-length compressed BWT of the suffixes of many texts that leave at least
    ``length`` bytes, with the suffixes at run heads sampled."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        size = np.array([len(t) for t in texts], np.int64)
        count = np.maximum(size - length + 1, 0)
        width = int(size.max(initial=0)) + 1
        padded = np.zeros((len(texts), 2 * width), np.uint8)
        for i, t in enumerate(texts):
            padded[i, :len(t)] = np.frombuffer(t, np.uint8)
        self.text = np.repeat(np.arange(len(texts)), count)
        self.start = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        self.left = size[self.text] - self.start  # bytes from here to the end of the text
        rows = np.lib.stride_tricks.sliding_window_view(padded, width, axis=1)[self.text, self.start]
        self.suffix = np.ascontiguousarray(rows).view(f"S{width}").ravel()
        self.order = np.argsort(self.suffix, kind="stable")
        before = np.where(self.start > 0, padded[self.text, np.maximum(self.start - 1, 0)].astype(np.int64), -1)
        bwt = before[self.order]
        self.head = np.ones(len(bwt), bool)
        self.head[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] < 0)  # no byte before: a run of its own
        self.runs = bwt[self.head], np.diff(np.append(np.flatnonzero(self.head), len(bwt)))
        self.samples = self.order[self.head]  # the suffix at each run head

    def _common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes i and j."""
        out = np.zeros(len(i), np.int64)
        step = max(1, (8 << 20) // max(self.suffix.itemsize, 1))
        rows = self.suffix.view(np.uint8).reshape(len(self.suffix), -1) if len(self.suffix) else None
        for k in range(0, len(i), step):
            a, b = rows[i[k:k + step]], rows[j[k:k + step]]
            differ = a != b
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
            out[k:k + step] = first
        return np.minimum(out, np.minimum(self.left[i], self.left[j]))

    def matching_statistics(self) -> np.ndarray:
        """Per suffix, in order of text and place, the longest match with another
        suffix in the sorted order above or below it.  Only run heads (and, below,
        run tails) are compared; elsewhere the match of the suffix one byte earlier,
        which sorts next to the same neighbour, goes on and is one byte shorter."""
        n = len(self.order)
        out = np.zeros(n, np.int64)
        if n < 2:
            return out
        for up in (True, False):
            edge = self.head if up else np.append(self.head[1:], True)
            at = np.flatnonzero(edge)
            near = at - 1 if up else at + 1
            has = (near >= 0) & (near < n)
            known = np.full(n, -1, np.int64)
            known[self.order[at]] = 0
            known[self.order[at[has]]] = self._common(self.order[at[has]], self.order[near[has]])
            # stream: value + place is carried on from the last known suffix of the text
            place = np.arange(n)
            last = np.maximum.accumulate(np.where(known >= 0, place, -1))
            out = np.maximum(out, np.maximum(known[last] - (place - last), 0))
        return out

    def repeated(self) -> np.ndarray:
        """Which suffixes begin with ``length`` bytes that another suffix begins with."""
        return self.matching_statistics() >= self.length


def _tally(key: np.ndarray, value: np.ndarray, twice: np.ndarray, hot: int) -> np.ndarray:
    """Answer bits of entries from all chunks in chunk order."""
    order = np.lexsort((value, key))
    k, v = key[order], value[order]
    new_key = np.append(True, k[1:] != k[:-1]) if len(k) else np.zeros(0, bool)
    new = new_key.copy()
    new[1:] |= v[1:] != v[:-1]
    group, pair = np.cumsum(new_key) - 1, np.cumsum(new) - 1
    times = np.bincount(pair, weights=1 + twice[order].astype(np.int64), minlength=1)[pair]
    kinds = np.bincount(group[new], minlength=1)[group]
    code = np.empty(len(key), np.uint16)
    code[order] = REPEATED * (times > 1) + MIXED * (kinds > 1) + FIRST * new + MANY * (kinds > hot)
    return code


class _Chunk:
    def __init__(self, ids: list, texts: list[bytes]):
        self.ids, self.texts = ids, texts
        self.starts = np.cumsum([0] + [len(t) for t in texts])
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.spans: list[tuple[np.ndarray, np.ndarray]] = []  # first and last window of repeated runs


def _unique(key: np.ndarray, value: np.ndarray, twice: np.ndarray | None = None):
    """Distinct pairs, whether each occurs twice or more, and each entry's pair."""
    pairs = np.stack([key, value], 1)
    order = np.lexsort((value, key))
    k = pairs[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]).any(axis=1)
    of = np.empty(len(k), np.int64)
    of[order] = np.cumsum(new) - 1
    n = np.bincount(of, weights=None if twice is None else 1 + twice, minlength=int(new.sum()))
    return k[new][:, 0], k[new][:, 1], n > 1, of, order[new]


class RepeatedBytes(Job):
    rounds = 3

    def __init__(self, length: int, id_type: str, hot: int = HOT):
        self.length, self.hot = length, hot
        self.gram = min(GRAM, max(1, length // 2))
        self.result = (f"id {id_type}, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary")

    def derive(self, ids, texts):
        return _Chunk(ids, texts)

    def ask(self, s, round_):
        if round_ == 0:
            s.range = ranges(s.data, s.starts, self.length, self.gram)
            s.one = _unique(s.range["key"], s.range["hull"])
            return {ENTRIES: (s.one[0], (s.one[0], s.one[1], s.one[2]))}
        if round_ == 1:
            return {ENTRIES: (s.two[0], (s.two[0], s.two[1], s.two[2]))}
        return {PIECES: (s.piece_core, s), WINDOWS: (s.window[0], (s.window[0], s.window[1], s.window[2]))}

    def pack(self, round_, kind, entries, which):
        if kind != PIECES:
            key, value, twice = entries
            return key[which].tobytes() + value[which].tobytes() + twice[which].astype(np.uint8).tobytes()
        texts = [entries.data[a:b].tobytes() for a, b in zip(entries.piece_lo[which],
                                                            entries.piece_hi[which] + self.length)]
        return (np.array([len(which)], np.uint32).tobytes() + np.array([len(t) for t in texts], np.uint16).tobytes()
                + b"".join(texts))

    def answer(self, round_, kind, payloads):
        if kind != PIECES:
            n = [len(p) // 17 for p in payloads]
            key = np.concatenate([np.frombuffer(p, np.uint64, k) for p, k in zip(payloads, n)])
            value = np.concatenate([np.frombuffer(p, np.uint64, k, 8 * k) for p, k in zip(payloads, n)])
            twice = np.concatenate([np.frombuffer(p, np.uint8, k, 16 * k) for p, k in zip(payloads, n)])
            return np.split(_tally(key, value, twice, self.hot), np.cumsum(n)[:-1])
        texts, n = [], []
        for p in payloads:
            k = int(np.frombuffer(p, np.uint32, 1)[0])
            size = np.frombuffer(p, np.uint16, k, 4).astype(np.int64)
            at = 4 + 2 * k + np.cumsum(size) - size
            texts += [p[a:a + m] for a, m in zip(at.tolist(), size.tolist())]
            n.append(k)
        # a code has a bit for each window of its text
        index = RunLengthIndex(texts, self.length)
        code = np.zeros(len(texts), np.int64)
        np.add.at(code, index.text, index.repeated().astype(np.int64) << index.start)
        return np.split(code.astype(np.uint16), np.cumsum(n)[:-1])

    def heard(self, s, round_, codes):
        if round_ == 0:
            code = codes[ENTRIES][s.one[3]]
            r = s.range
            whole = code & REPEATED > 0
            s.spans.append((r["first"][whole], r["last"][whole]))
            # who asks on: unsettled ranges, and one of each settled kind for them to meet
            representative = np.zeros(len(code), bool)
            representative[s.one[4]] = True
            on = (code & MIXED > 0) & (~whole | ((code & FIRST > 0) & representative))
            c = s.cell = cells(s.data, r["first"][on], r["last"][on], r["anchor"][on], self.length)
            s.settled = whole[on][c["range"]] if len(c["range"]) else np.zeros(0, bool)
            s.two = _unique(c["core"], c["hull"], s.settled)
            del s.range, s.one
        elif round_ == 1:
            code = codes[ENTRIES][s.two[3]]
            c = s.cell
            whole = (code & REPEATED > 0) & ~s.settled
            s.spans.append((c["lo"][whole], c["hi"][whole]))
            representative = np.zeros(len(code), bool)
            representative[s.two[4]] = True
            repeated = code & REPEATED > 0
            on = (code & MIXED > 0) & representative & (~repeated | (code & FIRST > 0))
            piece, many = on & (code & MANY == 0), on & (code & MANY > 0)
            s.piece_core, s.piece_lo, s.piece_hi = c["core"][piece], c["lo"][piece], c["hi"][piece]
            # windows of hot cells
            lo, n = c["lo"][many], (c["hi"] - c["lo"] + 1)[many]
            first = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            s.window_first = first
            s.window = _unique(self._hash(s.data, first), np.zeros(len(first), np.uint64),
                               np.repeat(repeated[many], n))
            del s.cell, s.two
        else:
            mask = codes[PIECES].astype(np.int64)
            for k in range(CELL):
                hit = mask >> k & 1 > 0
                s.spans.append((s.piece_lo[hit] + k, s.piece_lo[hit] + k))
            hit = codes[WINDOWS][s.window[3]] & REPEATED > 0
            s.spans.append((s.window_first[hit], s.window_first[hit]))

    def _hash(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.empty(len(first), np.uint64)
        order = np.argsort(first, kind="stable")
        at, i = first[order], 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(at, at[i] + (1 << 16), "left")))
            prefix = Prefix(data[at[i]:at[j - 1] + self.length])
            out[order[i:j]] = prefix.of(at[i:j] - at[i], at[i:j] - at[i] + self.length)
            i = j
        return out

    def finish(self, s):
        edge = np.zeros(len(s.data) + 1, np.int32)
        for first, last in s.spans:
            np.add.at(edge, first, 1)
            np.add.at(edge, last + self.length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        kept, spans, n = [], [], []
        for a, b in zip(s.starts[:-1].tolist(), s.starts[1:].tolist()):
            g = gone[a:b]
            n.append(b - a)
            kept.append(s.data[a:b][~g].tobytes() if g.any() else s.data[a:b].tobytes())
            cut = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
            spans.append([{"start": x, "stop": y} for x, y in zip(cut[::2].tolist(), cut[1::2].tolist())])
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return {"id": pa.array(s.ids, None if s.ids else pa.int64()), "n_bytes": pa.array(n, pa.int64()),
                "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())}


def remove_repeated_bytes(df: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                          hot: int = HOT) -> DataFrame:
    """(id, n_bytes, spans, kept): spans are the maximal removed runs [start, stop) in
    bytes, kept the bytes that are left; a row per row of ``df``."""
    kind = df.schema[id_col].dataType.simpleString()
    done = run_rounds(df, RepeatedBytes(length, kind, hot), id_col, text_col, "repeated-bytes")
    spans = "array<struct<start:bigint,stop:bigint>>"
    text = F.col(text_col).cast("binary")
    rest = df.where(F.col(id_col).isNull() | F.col(text_col).isNull()).select(
        F.col(id_col).alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.array().cast(spans).alias("spans"), F.coalesce(text, F.unhex(F.lit(""))).alias("kept"))
    return done.unionByName(rest).withColumnRenamed("id", id_col)
