"""Quality rules by tokeniser fertility.

A public vocabulary (a SentencePiece BPE model with byte fallback) is used as a
yardstick: fluent text of a script it covers takes few tokens per word, seldom
falls back to bytes, and spreads its tokens; noise does not.  Per document:

* ``chars_per_token``: code points in words / tokens,
* ``byte_share``: tokens that are byte fallbacks / tokens,
* ``token_entropy``: entropy in bits of the document's token distribution.

Each script has rejection bands for the three and for symbols per word (``BANDS``;
a caller may give its own, per script or per value of a language column).  The
model never merges across blanks, so each distinct word of an Arrow batch is
encoded once; texts are read whole, in one pass without a shuffle.

Null text counts as no words: every number is 0, ``base_failed`` is true and
``kept`` false.  Repeated rows give repeated results; only the id, text and (if
bands are by language) language columns are read, so clashing names cannot matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumisort._compat import worker_cache
from lumisort.llm.common import WORD_RE, bound_arrow, file_bytes

SYMBOLS = "#*$%&|<>"


BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class Band:
    """Limits of what is kept; ends are kept."""
    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    min_entropy: float
    max_symbols_per_word: float = 0.3

    def holds(self, chars_per_token: float, byte_share: float, entropy: float, symbols_per_word: float) -> bool:
        return (self.min_chars_per_token <= chars_per_token <= self.max_chars_per_token
                and byte_share <= self.max_byte_share and entropy >= self.min_entropy
                and symbols_per_word <= self.max_symbols_per_word)


#: By script of the letters. Scripts that write a word in one or two characters
#: have few characters a token; text of scripts outside the vocabulary is bytes.
BANDS: dict[str, Band] = {
    "latin": Band(1.55, 8.0, 0.12, 4.75),
    "cyrillic": Band(1.2, 8.0, 0.25, 4.5),
    "greek": Band(0.6, 8.0, 0.60, 4.0),
    "cjk": Band(0.4, 4.0, 0.80, 4.0),
    "other": Band(0.25, 8.0, 1.0, 3.5),
    "none": Band(0.8, 8.0, 0.5, 3.0),
}

#: First code point of each block run and its script, ascending.
SCRIPT_STARTS = (
    (0x0, "none"), (0x41, "latin"), (0x5B, "none"), (0x61, "latin"), (0x7B, "none"), (0xAA, "latin"), (0xAB, "none"),
    (0xC0, "latin"), (0xD7, "none"), (0xD8, "latin"), (0xF7, "none"), (0xF8, "latin"), (0x2B0, "none"),
    (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"),
    (0x2C00, "other"), (0x2E00, "none"), (0x2E80, "cjk"), (0x3000, "none"), (0x3040, "cjk"), (0xA000, "other"),
    (0xAC00, "cjk"), (0xD800, "none"), (0xF900, "cjk"), (0xFB00, "other"), (0xFE00, "none"), (0x10000, "other"),
    (0x1F000, "none"), (0x20000, "cjk"), (0x30000, "none"),
)


def script_of(text: str) -> str:
    """Script of most letters of the whole text (ties: the first by name)."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "none"
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    block = np.searchsorted(np.array([s for s, _ in SCRIPT_STARTS], np.uint32), cps, "right") - 1
    n = np.bincount(block, minlength=len(SCRIPT_STARTS))
    total: dict[str, int] = {}
    for (_, name), k in zip(SCRIPT_STARTS, n.tolist()):
        if name != "none" and k:
            total[name] = total.get(name, 0) + k
    return min(total, key=lambda s: (-total[s], s)) if total else "none"


class Fertility:
    """Encodes words with a SentencePiece model and measures documents."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.sp.get_piece_size()
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.size)])

    def measure(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per document (a list of words): tokens, byte-fallback tokens and entropy
        in bits.  Each distinct word of the batch is encoded once."""
        n_docs = len(docs)
        place: dict[str, int] = {}
        word = np.array([place.setdefault(w, len(place)) for words in docs for w in words], np.int64)
        if not len(word):
            return np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64), np.zeros(n_docs)
        enc = self.sp.encode([w.encode("utf-8", "replace").decode("utf-8") for w in place], num_threads=1)
        size = np.fromiter(map(len, enc), np.int64, len(enc))
        ids = np.fromiter(chain.from_iterable(enc), np.int64, int(size.sum()))
        del enc, place
        start = np.cumsum(size) - size
        doc = np.repeat(np.arange(n_docs), [len(x) for x in docs])
        per = size[word]  # tokens of each word in the text
        at = np.repeat(start[word] - (np.cumsum(per) - per), per) + np.arange(int(per.sum()))
        key = np.repeat(doc, per) * self.size + ids[at]
        n = np.bincount(np.repeat(doc, per), minlength=n_docs)
        key.sort()
        ends = np.flatnonzero(np.append(key[1:] != key[:-1], True))
        k, key = np.diff(ends, prepend=-1), key[ends]
        doc, ids = np.divmod(key, self.size)
        n_byte = np.bincount(doc, weights=k * self.is_byte[ids], minlength=n_docs).astype(np.int64)
        spread = np.bincount(doc, weights=k * np.log2(k), minlength=n_docs)
        some = np.maximum(n, 1)
        return n, n_byte, np.maximum(np.log2(some) - spread / some, 0.0)


def base_counts(text: str | None) -> tuple[list[str], int, int, int, int]:
    """Words, and code points in words, symbols, repeated lines, and words inside
    3-word windows that the text holds twice or more."""
    if not text:
        return [], 0, 0, 0, 0
    words = WORD_RE.findall(text)
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen: dict[tuple, int] = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        end = 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    return words, sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), repeated


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]
RESULTS = ([(c, pa.int64()) for c in COUNTS] + [("script", pa.string())]
           + [(c, pa.float64()) for c in ("chars_per_token", "byte_share", "token_entropy")]
           + [(c, pa.bool_()) for c in ("base_failed", "kept")])


def _judge_of(df: DataFrame, model_path: str, bands: Mapping[str, Band] | None, min_words: int, max_repeat_pct: int):
    """A function (texts, languages) -> columns of ``RESULTS`` for the workers."""
    spark = df.sparkSession
    bound_arrow(spark, BATCH_BYTES)
    model = spark.sparkContext.broadcast(file_bytes(model_path))
    limits = dict(BANDS if bands is None else bands)
    key = f"fertility:{model_path}"

    def judge(texts: list[str | None], langs: list[str | None]) -> list[pa.Array]:
        cache = worker_cache()
        if key not in cache:
            cache[key] = Fertility(model.value)
        base = [base_counts(x) for x in texts]
        n, n_byte, entropy = cache[key].measure([x[0] for x in base])
        got = []
        for i, (words, chars, symbols, dup, rep) in enumerate(base):
            script = script_of(texts[i]) if texts[i] else "none"
            nt, nw = int(n[i]), len(words)
            cpt, byte = (chars / nt, int(n_byte[i]) / nt) if nt else (0.0, 0.0)
            failed = nw < min_words or 100 * rep > max_repeat_pct * nw
            band = limits.get(langs[i]) or limits.get(script) or limits.get("other")
            ok = not failed and (band is None or band.holds(cpt, byte, float(entropy[i]), symbols / max(nw, 1)))
            got.append((nw, chars, symbols, dup, rep, nt, script, cpt, byte, float(entropy[i]), failed, ok))
        return [pa.array(c, t) for c, (_, t) in zip(zip(*got) if got else [[]] * len(RESULTS), RESULTS)]

    return judge


def quality_rules(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str | None = None, bands: Mapping[str, Band] | None = None,
                  min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """One row per row of ``df``: the id, word counts, the three fertility figures,
    ``base_failed`` and ``kept``.  ``bands`` is by script, or by ``lang_col`` value
    where that value has a band of its own."""
    judge = _judge_of(df, model_path, bands, min_words, max_repeat_pct)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(2).to_pylist() if lang_col else [None] * b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), *judge(b.column(1).to_pylist(), langs)],
                                             [id_col, *(name for name, _ in RESULTS)])

    kind = df.schema[id_col].dataType.simpleString()
    sql = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double", pa.bool_(): "boolean"}
    return df.select(id_col, text_col, *([lang_col] if lang_col else [])).mapInArrow(
        rows, f"`{id_col}` {kind}, " + ", ".join(f"{name} {sql[t]}" for name, t in RESULTS))


def keep_good(df: DataFrame, model_path: str, text_col: str = "text", lang_col: str | None = None,
              bands: Mapping[str, Band] | None = None, min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """The rows of ``df`` that ``quality_rules`` keeps, all columns, without a join."""
    judge = _judge_of(df, model_path, bands, min_words, max_repeat_pct)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(lang_col).to_pylist() if lang_col else [None] * b.num_rows
            yield b.filter(judge(b.column(text_col).to_pylist(), langs)[-1])

    return df.mapInArrow(rows, df.schema)
