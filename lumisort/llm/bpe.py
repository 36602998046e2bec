"""Byte-level BPE encoding and decoding with Spark higher-order functions.

A word (a match of the tokeniser's pattern) is a byte array; ``fold_merges`` folds
over its length and merges in each step the adjacent pair whose joined bytes have
the lowest rank (the first such pair on ties), as byte-pair encoding prescribes.
Ranks come from a map of the vocabulary, one value in the plan, cut into buckets by
CRC-32 so that a lookup reads a handful of entries.  Decoding looks every id up in an
array of pieces, again one value, and concatenates.

The words of all documents are counted, and the commonest (``dictionary_words``) are
folded once each and sent to the workers as a dictionary.  Words beyond it are merged
where they occur by ``merge_words``, the same rule on all new words of a batch side by
side, with a bounded memory of recent ones: folding the rare words of every batch as
well cost more than the limits allow (see the README).  The dictionary saves time and never changes a
result; no text is shuffled and nothing depends on how often a word occurs.

Texts are cut at blanks between words before the pattern is matched (``_Cuts``), so
that a part met before, in counting or in encoding, is not matched again.

Null text is empty: no tokens and empty bytes.  Repeated rows give repeated
results; only the id and text columns are read.
"""

from __future__ import annotations

import base64
import heapq
import json
import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, compress
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisort._compat import worker_cache
from lumisort.llm.common import bound_arrow, file_bytes, let, packed

BUCKETS = 1 << 12  # a power of two
PLACE_BITS = 11  # of a place in a word
MAX_FOLD = (1 << PLACE_BITS) - 1
NO_RANK = 2**29
NO_PAIR = NO_RANK << 3 * PLACE_BITS
BATCH_BYTES = 4 << 20
FOLD_CHARS = 256  # longest word of the dictionary
LONG_WORD = 100
FEW_WORDS = 8  # of one length: merged one by one
RECENT_WORDS = 200_000
BYTES = [bytes([i]) for i in range(256)]

#: Blanks beside white space (of any kind that a pattern may know) or at an end.
ODD_BLANK = r"^ | $|[\s\x0b\x1c-\x1f\x{85}\p{Z}] | [\s\x0b\x1c-\x1f\x{85}\p{Z}]"

#: Patterns whose matches hold white space at their start or are all white space, and look ahead at
#: white space only, and that leave out no character: a blank between two other characters always begins a match.
BLANK_STARTS = frozenset({r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"})


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes -> rank of a file of base64 pieces and ranks."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file_bytes(path).splitlines()) if a}


def _latin(piece: bytes) -> str:
    """Bytes as a string of as many characters (the form that the fold works on)."""
    return piece.decode("latin-1")


def with_table(df: DataFrame, name: str, value: list, schema: str) -> DataFrame:
    """``df`` with a fixed table in a column for plans to look up.  As a literal it would stand in every text that
    Spark keeps of the plan on the driver, a megabyte or two each time; a scalar subquery doesn't."""
    rows = df.sparkSession.createDataFrame([(json.dumps(value),)], "json string")
    return df.withColumn(name, rows.select(F.from_json("json", schema).alias(name)).scalar())


RANK_TABLE, PIECE_TABLE = "array<map<string,int>>", "array<string>"


def rank_buckets(ranks: dict[bytes, int]) -> list[dict[str, int]]:
    """The rank map: ``BUCKETS`` maps from piece to rank."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        text = _latin(piece)
        buckets[zlib.crc32(text.encode("utf-8")) % BUCKETS][text] = rank
    return buckets


def _rank(table: Column, piece: Column) -> Column:
    """Rank of a piece, ``NO_RANK`` if it has none."""
    bucket = F.crc32(piece.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    return F.coalesce(F.element_at(F.get(table, bucket), piece), F.lit(NO_RANK))


def _pair(table: Column, word: Column, start: Column, middle: Column, end: Column) -> Column:
    """The pair word[start:middle], word[middle:end] as one number that sorts by the
    rank of the joined bytes, then by place."""
    rank = _rank(table, F.substring(word, start + 1, end - start)).cast("long")
    return (F.shiftleft(rank, 3 * PLACE_BITS) + F.shiftleft(start.cast("long"), 2 * PLACE_BITS)
            + (F.shiftleft(middle, PLACE_BITS) + end).cast("long"))


def _place(pair: Column, k: int) -> Column:
    """Start (2), middle (1) or end (0) of a pair."""
    return F.shiftright(pair, k * PLACE_BITS).bitwiseAND(F.lit(MAX_FOLD).cast("bigint")).cast("int")


def fold_merges(table: Column, word: Column) -> Column:
    """Ids (array<int>) of a word given as a string of one character a byte, at most
    ``MAX_FOLD`` of them.  The state of the fold is the array of adjacent pairs."""
    n = F.length(word)

    def merge(pairs: Column, at: Column, pair: Column) -> Column:
        # pair ``at`` (1-based) becomes one part; the pairs on both sides are ranked anew
        none = F.array().cast("array<bigint>")
        start, end = _place(pair, 2), _place(pair, 0)
        left = F.when(at > 1, F.array(_pair(table, word, _place(F.get(pairs, at - 2), 2), start, end))).otherwise(none)
        right = F.when(at < F.size(pairs), F.array(_pair(table, word, start, end, _place(F.get(pairs, at), 0)))
                       ).otherwise(none)
        return F.concat(F.slice(pairs, 1, F.greatest(at - 2, F.lit(0))), left, right, F.slice(pairs, at + 2, n))

    def step(pairs: Column, _: Column) -> Column:
        return let(F.array_min(pairs), lambda low: F.when(
            low < NO_PAIR, let(F.array_position(pairs, low).cast("int"), lambda at: merge(pairs, at, low))
        ).otherwise(pairs))

    def parts(pairs: Column) -> Column:
        # every part but the last starts a pair
        ids = F.transform(pairs, lambda p: _rank(table, F.substring(
            word, _place(p, 2) + 1, _place(p, 1) - _place(p, 2))))
        last = F.when(F.size(pairs) > 0, _place(F.element_at(pairs, -1), 1)).otherwise(F.lit(0))
        return F.concat(ids, F.array(_rank(table, F.substring(word, last + 1, n))))

    def folded() -> Column:
        pairs = F.transform(F.sequence(F.lit(0), n - 2), lambda i: _pair(table, word, i, i + 1, i + 2))
        return F.aggregate(F.sequence(F.lit(2), n), pairs, step, parts)

    return F.when(n == 0, F.array().cast("array<int>")).otherwise(
        let(_rank(table, word), lambda whole: F.when(whole < NO_RANK, F.array(whole)).otherwise(folded())))


def encode_words(words: Column, ranks: dict[bytes, int], table: Column | None = None) -> Column:
    """array<string> of words (one character a byte) -> array<array<int>>; the rank
    map stands in the plan once, as a literal unless a column holds it (``with_table``)."""
    if table is None:
        table = F.from_json(F.lit(json.dumps(rank_buckets(ranks))), RANK_TABLE)
    return let(table, lambda table: F.transform(words, lambda w: fold_merges(table, w)))


def id_pieces(ranks: dict[bytes, int]) -> list[str]:
    """The pieces by id, in hexadecimal."""
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    return pieces


def decode_ids(ids: Column, ranks: dict[bytes, int], table: Column | None = None) -> Column:
    """Ids -> bytes: the pieces of the ids, concatenated; the pieces are a literal unless a column holds them."""
    if table is None:
        table = F.from_json(F.lit(json.dumps(id_pieces(ranks))), PIECE_TABLE)
    return F.unhex(let(table, lambda t: F.array_join(F.transform(ids, lambda i: F.get(t, i)), "")))


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: the same merges one by one, in plain Python."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return merge_long(word, ranks)
    get = ranks.get
    parts = [BYTES[c] for c in word]
    pairs = [get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while pairs and (low := min(pairs)) < NO_RANK:
        i = pairs.index(low)
        part = parts[i] = parts[i] + parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + part, NO_RANK)
        if i < len(pairs):
            pairs[i] = get(part + parts[i + 1], NO_RANK)
    return [ranks[p] for p in parts]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word in n log n: a heap of ranked pairs over a
    linked list of parts; stale heap entries are skipped."""
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that begins at i; 0 if none does
    before = list(range(-1, n - 1))

    def pair(i: int) -> int | None:
        j = end[i]
        return ranks.get(word[i:end[j]]) if j < n else None

    heap = [(r, i, i + 2) for i in range(n - 1) if (r := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j] = end[j], 0
        if end[i] < n:
            before[end[i]] = i
        for k in (before[i], i):
            if k >= 0 and (r := pair(k)) is not None:
                heapq.heappush(heap, (r, k, end[end[k]]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class PairRanks:
    """Ranks of joined pieces by the ids of both, for ``merge_words``.  A byte that is no piece itself has an id
    beyond all ranks here."""

    def __init__(self, ranks: dict[bytes, int]):
        self.top = max(ranks.values(), default=-1)
        ids = {c: self.top + 1 + i for i, c in enumerate(BYTES)} | ranks
        found = sorted((left << 32 | right, rank) for piece, rank in ranks.items() for k in range(1, len(piece))
                       if (left := ids.get(piece[:k])) is not None and (right := ids.get(piece[k:])) is not None)
        found.append((np.iinfo(np.int64).max, NO_RANK))  # a place for what comes after all
        self.key = np.array([k for k, _ in found], np.int64)
        self.rank = np.array([r for _, r in found], np.int32)
        self.byte = np.array([ids[c] for c in BYTES], np.int32)
        self.two = self.of(np.repeat(self.byte, 256), np.tile(self.byte, 256))  # of two bytes

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.rank[at], np.int32(NO_RANK))


def _merge_even(words: list[bytes], pairs: PairRanks) -> list[bytes]:
    """Ids (int32 bytes) of words of one length, merged side by side: each step merges one pair of every word that
    has any left, so the rows stay equally long."""
    out = [b""] * len(words)
    data = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
    ids, rank = pairs.byte[data], pairs.two[data[:, :-1].astype(np.int32) << 8 | data[:, 1:]]
    row = np.arange(len(words))
    while len(row):
        n = ids.shape[1]
        low = rank.argmin(axis=1) if n > 1 else np.zeros(len(row), np.int64)  # the first on ties
        least = rank[np.arange(len(row)), low] if n > 1 else np.full(len(row), NO_RANK, np.int32)
        done = least == NO_RANK
        if done.any():
            if (ids[done] > pairs.top).any():
                raise KeyError("a byte without a rank")
            whole = ids[done].astype("<i4").tobytes()
            for k, i in enumerate(row[done].tolist()):
                out[i] = whole[4 * n * k:4 * n * (k + 1)]
            ids, rank, low, least, row = (x[~done] for x in (ids, rank, low, least, row))
            if not len(row):
                break
        all_ = np.arange(len(row))
        ids[all_, low] = least  # a piece's id is its rank
        stay = np.ones(ids.shape, bool)
        stay[all_, low + 1] = False
        ids = ids[stay].reshape(len(row), n - 1)
        stay = np.ones(rank.shape, bool)
        stay[all_, low] = False
        rank = rank[stay].reshape(len(row), n - 2)
        i = np.flatnonzero(low > 0)
        rank[i, low[i] - 1] = pairs.of(ids[i, low[i] - 1], least[i])
        i = np.flatnonzero(low < n - 2)
        rank[i, low[i]] = pairs.of(least[i], ids[i, low[i] + 1])
    return out


def merge_words(words: list[bytes], ranks: dict[bytes, int], pairs: PairRanks) -> list[bytes]:
    """``merge_word`` of many words, as int32 bytes: short words of one length together."""
    out, even = [b""] * len(words), defaultdict(list)
    for i, word in enumerate(words):
        whole = ranks.get(word)
        if whole is not None:
            out[i] = pack("<i", whole)
        else:
            even[len(word)].append(i)
    for n, at in even.items():
        if 0 < n <= LONG_WORD and len(at) >= FEW_WORDS:
            coded = _merge_even([words[i] for i in at], pairs)
        else:
            coded = [pack(f"<{len(ids)}i", *ids) for ids in (merge_word(words[i], ranks) for i in at)]
        for i, ids in zip(at, coded):
            out[i] = ids
    return out


def _splitter(pattern: str):
    import regex
    cache = worker_cache()
    if ("bpe", pattern) not in cache:
        cache["bpe", pattern] = regex.compile(pattern)
    return cache["bpe", pattern]


def _cutter(pattern: str) -> Callable[[str], list[str]]:
    """Cuts a text into parts whose matches together are those of the text.  All parts but the
    first lack the blank that begins them."""
    if pattern not in BLANK_STARTS:
        return lambda text: [text]
    return re.compile(r" (?<=\S )(?=\S)").split


class _Cuts:
    """Texts of a batch, cut.  ``parts``: the distinct parts that lack their blank; ``index``: for every part of every
    text its number there, from ``starts`` on for each text; at ``starts`` stand the first parts (``firsts``), which
    lack none.  Texts with other white space beside a blank, or a blank at an end, are first parts as a whole here, to
    be cut by ``_cutter``; ``odd`` has their places."""

    def __init__(self, texts: pa.Array, pattern: str):
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD_BLANK) if pattern in BLANK_STARTS else pa.array([True] * len(texts), pa.bool_())
        pieces = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        coded = pieces.values.dictionary_encode()
        self.starts, self.index = pieces.offsets.to_numpy(), coded.indices.to_numpy()
        first = self.index[self.starts[:-1]]
        self.parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.firsts = [self.parts[i] for i in first.tolist()]
        self.odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        for i in self.odd:
            self.firsts[i] = texts[i].as_py()

    def times(self) -> np.ndarray:
        """How often each part occurs, not as a first one."""
        n = len(self.parts)
        return np.bincount(self.index, minlength=n) - np.bincount(self.index[self.starts[:-1]], minlength=n)


def _words(parts: Iterable[str], find: Callable[[str], list[str]]) -> tuple[list[str], list[str], np.ndarray]:
    """Parts that lack their blank, in an order of its own, their words one after the other, and how many each has.
    A part that does not end in white space ends a match as well, so all such parts are matched at once."""
    tight, loose = [], []
    for p in parts:
        (loose if not p or p[-1].isspace() else tight).append(p)
    words = find(" ".join(["", *tight])) if tight else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    part_ends = np.cumsum(np.fromiter(map(len, tight), np.int64, len(tight)) + 1)
    n = np.diff(np.searchsorted(ends, part_ends, "right"), prepend=0).tolist()
    for p in loose:
        more = find(" " + p)
        words += more
        n.append(len(more))
    return tight + loose, words, np.array(n, np.int64)


class TextCoder:
    """Ids (int32 bytes) of texts.  The words of ``known`` are looked up; all other words of a batch are merged
    together (``merge_words``), a distinct one once.  ``words`` remembers them, and ``parts`` the parts of texts by
    what follows their blank, up to ``memory`` of each; neither known nor long ones count there."""

    def __init__(self, pattern: str, known: dict[str, bytes], ranks: dict[bytes, int], pairs: PairRanks,
                 memory: int = RECENT_WORDS):
        self.find, self.cut = _splitter(pattern).findall, _cutter(pattern)
        self.pattern, self.known, self.ranks, self.pairs, self.memory = pattern, known, ranks, pairs, memory
        # a word is the one match of itself (see BLANK_STARTS)
        self.known_parts = {w[1:]: ids for w, ids in known.items() if w.startswith(" ")}
        self.words, self.parts = self.known.copy(), self.known_parts.copy()

    def _learn(self, firsts: list[list[str]], parts: set[str]) -> list[str]:
        """Remembers these words and parts; returns the new words."""
        parts, found, n = _words(parts, self.find)
        new = list(set(chain(found, *firsts)).difference(self.words))
        self.words.update(zip(new, merge_words([w.encode("utf-8") for w in new], self.ranks, self.pairs)))
        ids = list(map(self.words.__getitem__, found))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        end = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])].tolist()
        whole = b"".join(ids)
        self.parts.update(zip(parts, [whole[a:b] for a, b in zip(end, end[1:])]))
        return new

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and where each text's begin; the end of the last too."""
        if len(self.words) - len(self.known) > self.memory:
            self.words = self.known.copy()
        if len(self.parts) - len(self.known_parts) > self.memory:
            self.parts = self.known_parts.copy()
        cuts = _Cuts(texts, self.pattern)
        odd = [self.cut(cuts.firsts[i]) for i in cuts.odd]
        for i, parts in zip(cuts.odd, odd):
            cuts.firsts[i] = parts.pop(0)
        firsts = [self.find(first) for first in cuts.firsts]
        parts = set(compress(cuts.parts, cuts.times())).union(*odd).difference(self.parts)
        words = self._learn(firsts, parts)
        one, part = self.words.__getitem__, self.parts.__getitem__
        coded = [b"".join(map(one, first)) for first in firsts]
        for i, rest in zip(cuts.odd, odd):
            coded[i] += b"".join(map(part, rest))
        # a table of ids by part (none for what is a first part only), then by text for the first parts
        coded = [*(self.parts.get(p, b"") for p in cuts.parts), *coded]
        index = cuts.index.copy()
        index[cuts.starts[:-1]] = np.arange(len(cuts.parts), len(coded))
        for memory, new in ((self.words, words), (self.parts, parts)):
            for w in new:
                if len(w) > FOLD_CHARS:
                    del memory[w]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        ids = np.frombuffer(b"".join(coded), "<i4")
        size_at = size[index]
        end = np.concatenate([[0], np.cumsum(size_at)])
        out = ids[np.repeat((np.cumsum(size) - size)[index] - end[:-1], size_at) + np.arange(end[-1])]
        return out, end[cuts.starts]


def count_words(df: DataFrame, text_col: str, pattern: str) -> DataFrame:
    """(word, n): how often each word of up to ``FOLD_CHARS`` characters occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, cut, words, parts = _splitter(pattern).findall, _cutter(pattern), Counter(), Counter()

        def settle() -> None:
            names, found, n = _words(parts, find)
            times = np.repeat(np.array([parts[p] for p in names], np.int64), n).tolist()
            for w, k in zip(found, times):
                if len(w) <= FOLD_CHARS:
                    words[w] += k
            parts.clear()

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(words), pa.string()),
                                              "n": pa.array(list(words.values()), pa.int64())})
            words.clear()
            return out

        for b in batches:
            cuts = _Cuts(b.column(0), pattern)
            for i in cuts.odd:
                cuts.firsts[i], *rest = cut(cuts.firsts[i])
                parts.update(rest)
            for part, n in zip(cuts.parts, cuts.times().tolist()):
                if n:
                    parts[part] += n
            words.update(w for first in cuts.firsts for w in find(first) if len(w) <= FOLD_CHARS)
            if len(parts) > RECENT_WORDS:
                settle()
            if len(words) > RECENT_WORDS:
                yield batch()
        settle()
        yield batch()

    return df.select(text_col).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def common_words(df: DataFrame, text_col: str, pattern: str, ranks: dict[bytes, int], dictionary_words: int) -> bytes:
    """The commonest words of all texts with their ids, at most ``dictionary_words``, none that occurs
    once only, as one Arrow stream (see ``word_ids``)."""
    counts = count_words(df, text_col, pattern).where(F.col("n") > 1).cache()
    try:
        steps = counts.groupBy(F.floor(F.log2("n") * 4).alias("step")).agg(F.count(F.lit(1)).alias("k")).collect()
        least, total = None, 0  # the lowest step that still fits the bound
        for r in sorted(steps, key=lambda r: -r["step"]):
            total += r["k"]
            if total > dictionary_words:
                break
            least = r["step"]
        if least is None:
            return b""
        latin = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
        chosen = with_table(counts.where(F.floor(F.log2("n") * 4) >= least), "ranks", rank_buckets(ranks), RANK_TABLE)
        coded = chosen.select("word", F.element_at(encode_words(F.array(latin), ranks, F.col("ranks")), 1).alias("ids"))
        got = coded.toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, got.schema) as out:
            out.write_table(got)
        return sink.getvalue().to_pybytes()
    finally:
        counts.unpersist()


def word_ids(stream: bytes) -> dict[str, bytes]:
    """Word -> ids (int32 bytes) of an Arrow stream of ``common_words``, kept by the worker for its next tasks."""
    cache = worker_cache()
    key = ("bpe-words", len(stream), zlib.crc32(stream))
    if stream and key not in cache:
        got = pa.ipc.open_stream(stream).read_all().combine_chunks()
        ids = got.column("ids").combine_chunks() if got.num_rows else None
        flat, at = (ids.values.to_numpy().astype("<i4").tobytes(), ids.offsets.to_pylist()) if got.num_rows else (b"", [])
        for old in [k for k in cache if k[0] == "bpe-words"]:
            del cache[old]
        cache[key] = {w.as_py(): flat[4 * a:4 * b] for w, a, b in zip(got.column("word"), at, at[1:])}
    return cache[key] if stream else {}


def bpe_encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               dictionary_words: int = 200_000) -> DataFrame:
    """(id, ids array<int>, ids_le): one row per row of ``df``; ``ids_le`` holds the ids
    as little-endian 32-bit integers."""
    spark = df.sparkSession
    bound_arrow(spark, BATCH_BYTES)
    ranks = read_ranks(ranks_path)
    # the words pass the driver as one block of bytes; the workers make a dictionary of it
    known = spark.sparkContext.broadcast(common_words(df, text_col, pattern, ranks, dictionary_words))
    vocabulary = spark.sparkContext.broadcast(packed((ranks, PairRanks(ranks))))
    id_type = df.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = TextCoder(pattern, word_ids(known.value), *pickle.loads(vocabulary.value))
        for b in batches:
            ids, starts = coder.encode(b.column(1))
            starts = starts.astype(np.int32)
            # the same bytes, as numbers and as they are
            as_bytes = pa.Array.from_buffers(pa.binary(), len(b.column(0)), [None, pa.py_buffer(4 * starts), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(starts), pa.array(ids)),
                                              as_bytes], [id_col, "ids", "ids_le"])

    return df.select(id_col, text_col).mapInArrow(encode, f"`{id_col}` {id_type}, ids array<int>, ids_le binary")
