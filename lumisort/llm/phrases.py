"""Repeated passages across documents, located by Aho-Corasick automata.

A window is ``window`` consecutive words of one document; a word is removed if it
lies in a window whose words also start in a document with a smaller id.  Windows
are judged on the input.

1. Each window has a key, the smallest hash of the ``GRAM``-word grams in it; equal
   windows have equal keys, and neighbours mostly share theirs.  Chunks of documents
   ask which keys occur in two documents or more (see ``rounds``).
2. Windows with such a key are confirmed by a hash of all their words, with the
   smallest id that holds them; the answer says whether a smaller id exists.
3. Each chunk, a shard of documents, compiles its confirmed passages (maximal runs of
   recurring windows, words as characters) into an Aho-Corasick automaton, valued by
   the id from which on they count, and streams all its documents through it; every
   occurrence in a document with a larger id than that is removed.

A passage that very many documents hold is one entry per chunk and window in every
round and one pattern in a chunk's automaton; text is dealt to chunks once.

Null text has no words.  Rows that repeat with one id are no copies of each other
(no smaller id), nor are rows without an id, which stay whole.  Ids are integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisort.llm.cells import BLOCK, Prefix, mix, sliding_min
from lumisort.llm.common import WORD_PATTERN
from lumisort.llm.rounds import Job, run_rounds

GRAM = 6
KEY_BYTES = 6  # of a key in the first round, which only filters
EVERYONE = -(2 ** 63)  # value of a passage that a smaller id outside the chunk holds
U = np.uint64


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * U(0x9E3779B97F4A7C15) + h[i:i + len(out)]
    return mix(out)


WIDTH, FIRST_CHARACTERS = 2, 128


def as_characters(codes: np.ndarray) -> str:
    """Word numbers as a string, ``WIDTH`` characters a word: the first from a small
    range, as an automaton tries the branches of a state one by one and its root has
    one for every first character, the second from a range apart from it, so that
    matches begin where words do."""
    second = codes // FIRST_CHARACTERS + 0x1000
    second = np.where(second >= 0xD800, second + 0x800, second)  # no surrogates
    return np.stack([codes % FIRST_CHARACTERS + 1, second], 1).astype("<u4").tobytes().decode("utf-32-le")


IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
LONG = 256  # bytes of a word from which on it is hashed on its own


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of each word data[start:stop], from prefix sums over blocks."""
    out = np.empty(len(start), np.uint64)
    short = np.flatnonzero(stop - start <= LONG)
    for k in np.flatnonzero(stop - start > LONG).tolist():
        import xxhash
        out[k] = xxhash.xxh3_64_intdigest(data[start[k]:stop[k]].tobytes())
    a, b, i = start[short], stop[short], 0
    while i < len(short):
        j = max(i + 1, int(np.searchsorted(a, a[i] + BLOCK - LONG, "left")))
        out[short[i:j]] = Prefix(data[a[i]:b[j - 1]]).of(a[i:j] - a[i], b[i:j] - a[i])
        i = j
    return out


class _Chunk:
    def __init__(self, ids: list[int], texts: list[bytes], window: int, gram: int):
        self.ids = np.array(ids, np.int64)
        # texts end to end, each with a line end after it, so that every word has a blank behind it
        self.data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
        blank = IS_BLANK[self.data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1 if len(blank) else np.zeros(0, np.int64)
        if len(blank) and not blank[0]:
            edge = np.append(0, edge)
        self.word, self.stop = edge[::2], edge[1::2]
        self.starts = np.searchsorted(self.word, np.cumsum([0] + [len(t) + 1 for t in texts]))
        self.hash = word_hashes(self.data, self.word, self.stop)
        n = max(0, len(self.word) - window + 1)
        self.first = np.zeros(0, np.int64)
        if not n:
            return
        doc = np.searchsorted(self.starts, np.arange(n), "right") - 1
        inside = self.starts[doc + 1] >= np.arange(n) + window
        self.first = np.flatnonzero(inside)  # windows by first word
        self.doc = doc[inside]
        self.key = sliding_min(_grams(self.hash, gram), window - gram + 1)[:n][inside]

    def kept_texts(self, gone: np.ndarray) -> list[str]:
        """Words that stay, joined by one space, per document."""
        stay = ~gone
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.word[stay]] = 1
        edge[self.stop[stay] + 1] -= 1  # with the blank behind it
        take = np.cumsum(edge[:-1], dtype=np.int8) > 0
        data = self.data.copy()
        data[self.stop] = 0x20
        size = np.where(stay, self.stop - self.word + 1, 0)
        at = np.append(0, np.cumsum(size))[self.starts].tolist()
        out = data[take].tobytes()
        return [out[a:b - 1].decode("utf-8", "replace") if b > a else "" for a, b in zip(at, at[1:])]


class RepeatedPassages(Job):
    rounds = 2

    def __init__(self, window: int, id_type: str):
        self.window, self.gram = window, min(GRAM, window)
        self.result = (f"id {id_type}, n_words bigint, spans array<struct<start:bigint,stop:bigint>>, kept string")

    def derive(self, ids, texts):
        return _Chunk(ids, texts, self.window, self.gram)

    def ask(self, s, round_):
        if round_ == 0:
            if not len(s.first):
                return {0: (np.zeros(0, np.uint64), np.zeros(0, bool))}
            run = np.ones(len(s.key), bool)  # neighbours with one key in one document
            run[1:] = (s.key[1:] != s.key[:-1]) | (s.doc[1:] != s.doc[:-1])
            s.run_of = np.cumsum(run) - 1
            key, s.key_of = np.unique(s.key[run], return_inverse=True)
            doc = s.doc[run]
            lo, hi = np.full(len(key), len(s.ids)), np.full(len(key), -1)
            np.minimum.at(lo, s.key_of, doc)
            np.maximum.at(hi, s.key_of, doc)
            return {0: (key, (key, s.ids[hi] > s.ids[lo]))}
        return {0: (s.confirm[0], s.confirm)}

    def pack(self, round_, kind, entries, which):
        if round_ == 0:
            key, twice = entries
            low = key[which].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            return (np.array([len(which)], np.uint32).tobytes() + low.tobytes()
                    + np.packbits(twice[which], bitorder="little").tobytes())
        key, least = entries
        ids, of = np.unique(least[which], return_inverse=True)
        return (np.array([len(which), len(ids)], np.uint32).tobytes() + key[which].tobytes() + ids.tobytes()
                + of.astype(np.uint32).tobytes())

    def answer(self, round_, kind, payloads):
        keys, other = [], []
        for p in payloads:
            n = int(np.frombuffer(p, np.uint32, 1)[0])
            if round_ == 0:
                wide = np.zeros((n, 8), np.uint8)
                wide[:, :KEY_BYTES] = np.frombuffer(p, np.uint8, KEY_BYTES * n, 4).reshape(n, KEY_BYTES)
                keys.append(wide.view("<u8").ravel().astype(np.uint64))
                bits = np.frombuffer(p, np.uint8, -1, 4 + KEY_BYTES * n)
                other.append(np.unpackbits(bits, count=n, bitorder="little").astype(np.int64))
            else:
                m = int(np.frombuffer(p, np.uint32, 1, 4)[0])
                keys.append(np.frombuffer(p, np.uint64, n, 8))
                ids = np.frombuffer(p, np.int64, m, 8 + 8 * n)
                other.append(ids[np.frombuffer(p, np.uint32, n, 8 + 8 * (n + m))])
        key, value = np.concatenate(keys), np.concatenate(other)
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        code = np.empty(len(key), np.uint16)
        if round_ == 0:  # in two documents or more
            code[order] = np.bincount(group, weights=1 + value[order])[group] > 1
        else:  # a smaller id holds it
            code[order] = np.minimum.reduceat(value[order], first)[group] < value[order]
        return np.split(code, np.cumsum([len(k) for k in keys])[:-1])

    def heard(self, s, round_, codes):
        code = codes[0] > 0
        if round_ == 0:
            s.at = np.flatnonzero(code[s.key_of][s.run_of]) if len(s.first) else np.zeros(0, np.int64)
            if len(s.at):
                whole = _grams(s.hash, self.window)[s.first[s.at]]
                key, index, s.of = np.unique(whole, return_index=True, return_inverse=True)
                s.confirm = key, s.ids[s.doc[s.at]][index]  # documents are sorted: the first has the smallest id
            else:
                s.of, s.confirm = np.zeros(0, np.int64), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        else:
            s.value = np.where(code, EVERYONE, s.confirm[1])[s.of]

    def finish(self, s):
        gone = self._locate(s)
        spans, n = [], np.diff(s.starts)
        for a, b in zip(s.starts[:-1].tolist(), s.starts[1:].tolist()):
            cut = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
            spans.append([{"start": x, "stop": y} for x, y in zip(cut[::2].tolist(), cut[1::2].tolist())])
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return {"id": pa.array(s.ids, pa.int64()), "n_words": pa.array(n, pa.int64()), "spans": pa.array(spans, span),
                "kept": pa.array(s.kept_texts(gone), pa.string())}

    def _locate(self, s) -> np.ndarray:
        """Words of the chunk in an occurrence of a confirmed passage that counts there."""
        import ahocorasick
        gone = np.zeros(len(s.word), bool)
        if not len(s.first) or not len(s.at):
            return gone
        counts = s.value < s.ids[s.doc[s.at]]
        at, doc, value = s.first[s.at][counts], s.doc[s.at][counts], s.value[counts]
        if not len(at):
            return gone
        text, width = as_characters(np.unique(s.hash, return_inverse=True)[1]), WIDTH
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1
        limit = np.maximum.reduceat(value, head)  # each window counts above its own value
        automaton = ahocorasick.Automaton()
        for a, b, v in zip(at[head].tolist(), (at[tail] + self.window).tolist(), limit.tolist()):
            automaton.add_word(text[a * width:b * width], (b - a, v))
        automaton.make_automaton()
        edge = np.zeros(len(s.word) + 1, np.int32)
        for d, a, b in zip(s.ids.tolist(), s.starts[:-1].tolist(), s.starts[1:].tolist()):
            if b - a >= self.window:
                for end, (size, above) in automaton.iter(text[a * width:b * width]):  # it copies what it is given
                    if d > above:
                        stop = a + end // width + 1
                        edge[stop - size] += 1
                        edge[stop] -= 1
        return np.cumsum(edge[:-1]) > 0


def remove_repeated_passages(df: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, spans, kept): spans are the maximal removed runs [start, stop) in
    words, kept the words that are left, joined by one space; a row per row of ``df``."""
    kind = df.schema[id_col].dataType.simpleString()
    done = run_rounds(df, RepeatedPassages(window, kind), id_col, text_col, "repeated-passages")
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD_PATTERN), F.lit(0))
    rest = df.where(F.col(id_col).isNull() | F.col(text_col).isNull()).select(
        F.col(id_col).alias("id"), F.size(words).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"),
        F.array_join(words, " ").alias("kept"))
    return done.unionByName(rest).withColumnRenamed("id", id_col)
