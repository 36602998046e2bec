import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lumisort.llm import bpe, queries

PATH = P.path(queries.BYTE_RANKS)
RANKS = bpe.read_ranks(PATH)
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    rng = random.Random(1)
    letters = "abcdefgh  ,.\n\t0123'sßüéñ中文字한국 \x1c\x85  🙂aa"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    return out + [None, "", "a" * 3000, "ab" * 1500, "x" * 1025, "thé " * 500, "don't I'LL <|endoftext|>"]


def test_ids_and_bytes_match_the_library(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for options in ({}, {"dictionary_words": 0}):
        out = bpe.bpe_encode(df, PATH, P.PATTERN, **options)
        got = out.select("doc_id", "ids", "ids_le", bpe.decode_ids(F.col("ids"), RANKS).alias("back")).collect()
        assert len(got) == len(rows)
        for r in got:
            text = rows[r.doc_id][1] or ""
            assert list(r.ids) == REFERENCE.encode_ordinary(text), text
            assert bytes(r.back) == text.encode() and bytes(r.ids_le) == np.array(r.ids, "<u4").tobytes()


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op9_byte_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = REFERENCE.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_merge_long_is_the_same_rule():
    rng = random.Random(4)
    for _ in range(200):
        word = bytes(rng.choice(b"thean \xc3\xa9ing") for _ in range(rng.randint(1, 40)))
        want = REFERENCE._encode_single_piece(word)
        assert bpe.merge_word(word, RANKS) == want
        assert bpe.merge_long(word, RANKS) == want or word in RANKS


def test_fold_of_every_word(spark):
    rng = random.Random(6)
    words = [bytes(rng.choice(b"thean \xc3\xa9ing") for _ in range(rng.randint(1, 60))) for _ in range(200)] + [b""]
    df = spark.createDataFrame([(i, w.decode("latin-1")) for i, w in enumerate(words)], "i int, w string")
    got = df.select("i", bpe.encode_words(F.array("w"), RANKS)[0].alias("ids")).collect()
    for r in got:
        assert list(r.ids) == (REFERENCE._encode_single_piece(words[r.i]) if words[r.i] else [])


def test_odd_and_empty_tables(odd_docs, no_docs):
    got = bpe.bpe_encode(odd_docs, PATH, P.PATTERN).collect()
    assert len(got) == odd_docs.count()
    assert {r.doc_id: len(r.ids) for r in got if r.doc_id in (3, 4)} == {3: 0, 4: 0}
    assert bpe.bpe_encode(no_docs, PATH, P.PATTERN).count() == 0


def test_words_of_all_documents_are_counted(spark):
    """Once in each of two batches, beside 40,000 other documents: a sample or a batch of its own would miss it."""
    filler = spark.range(40_000).select(F.lit("thean one").alias("text"))
    rare = spark.createDataFrame([("x zqzqzq  zqzqzq\tzqzqzq",), (None,)], "text string").coalesce(1)
    df = filler.coalesce(1).unionByName(rare).unionByName(rare)
    got = {r.word: r.n for r in bpe.count_words(df, "text", P.PATTERN).collect()}
    assert got == {"thean": 40_000, " one": 40_000, "x": 2, " zqzqzq": 4, " ": 2, "\t": 2, "zqzqzq": 2}
    have = bpe.word_ids(bpe.common_words(df, "text", P.PATTERN, RANKS, 100))
    assert have.keys() == got.keys()
    assert all(list(np.frombuffer(ids, "<i4")) == REFERENCE.encode_ordinary(w) for w, ids in have.items())


def test_cut_texts_have_the_same_words():
    rng = random.Random(9)
    letters = "ab1 '  \u3000\xa0\n\t\x1c\x85  !\xe9\u4e2ds \r\U0001f600"
    assert P.PATTERN in bpe.BLANK_STARTS
    find, cut = bpe._splitter(P.PATTERN).findall, bpe._cutter(P.PATTERN)
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        first, *rest = cut(text)
        assert find(first) + [w for part in rest for w in find(" " + part)] == find(text)
    assert bpe._cutter("[a-z ]+")("a b") == ["a b"]


def odd_texts(n):
    rng = random.Random(12)
    letters = "ab1 '  \u3000\xa0\n\t\x1c\x85  !\xe9\u4e2ds \r\U0001f600"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(n)] + texts()


def test_words_merged_side_by_side():
    rng = random.Random(8)
    pairs = bpe.PairRanks(RANKS)
    words = [bytes(rng.choice(b"thean \xc3\xa9ing") for _ in range(rng.randint(1, 130))) for _ in range(3000)]
    words += [b"a" * n for n in range(1, 130) for _ in range(9)] + [b"abab" * n for n in range(1, 30)]
    for got, word in zip(bpe.merge_words(words, RANKS, pairs), words, strict=True):
        assert np.frombuffer(got, "<i4").tolist() == REFERENCE._encode_single_piece(word), word
    assert bpe.merge_words([], RANKS, pairs) == []
    # bytes that are no pieces may still be halves of one
    toy = {b"a": 0, b"b": 1, b"xy": 2, b"axy": 3, b"xya": 4}
    got = bpe.merge_words([b"axyab"] * 20, toy, bpe.PairRanks(toy))
    assert {tuple(np.frombuffer(x, "<i4")) for x in got} == {tuple(bpe.merge_word(b"axyab", toy))} == {(3, 0, 1)}
    with pytest.raises(KeyError):
        bpe.merge_words([b"axb"] * 20, toy, bpe.PairRanks(toy))


def test_coder_matches_new_parts_only():
    """The pattern is matched once a batch for all new parts and once a text for its first part, also where the
    memory overflows; all words of the dictionary stay known."""
    all_texts = odd_texts(3000)
    known = {w: np.array(REFERENCE.encode_ordinary(w), "<i4").tobytes() for w in (" thean", " one", "!", "\n", " a b")}
    for memory in (0, 10**6):
        coder = bpe.TextCoder(P.PATTERN, known, RANKS, bpe.PairRanks(RANKS), memory)
        for i in range(0, len(all_texts), 500):
            some = all_texts[i:i + 500]
            ids, starts = coder.encode(pa.array(some, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [
                REFERENCE.encode_ordinary(x or "") for x in some]
    calls, find = [], coder.find
    for memory in (0, 10**6):
        coder = bpe.TextCoder(P.PATTERN, known, RANKS, bpe.PairRanks(RANKS), memory)
        coder.find = lambda text: calls.append(text) or find(text)
        for _ in range(3):
            calls.clear()
            coder.encode(pa.array(["x thean one", "y thean one", "z new, one newer."], pa.string()))
            assert [c for c in calls if c not in "xyz"] in ([" new, newer."], [" newer. new,"], [])
        assert (memory == 0) == (len(calls) == 4)


def test_counts_of_odd_texts(spark):
    all_texts = odd_texts(3000)
    find = bpe._splitter(P.PATTERN).findall
    want = Counter(w for x in all_texts for w in find(x or "") if len(w) <= bpe.FOLD_CHARS)
    df = spark.createDataFrame([(x,) for x in all_texts], "text string").repartition(3)
    assert {r.word: r.n for r in bpe.count_words(df, "text", P.PATTERN).collect()} == want


def test_plans_do_not_hold_the_vocabulary(spark):
    """Spark keeps the text of every plan on the driver."""
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    words = bpe.with_table(df, "ranks", bpe.rank_buckets(RANKS), bpe.RANK_TABLE).select(
        bpe.encode_words(F.array("text"), RANKS, F.col("ranks"))[0].alias("ids"))
    assert list(words.first().ids) == REFERENCE._encode_single_piece(b"a b")
    for plan in (queries.bpe_digests(df), words):
        assert len(plan._jdf.queryExecution().toString()) < 100_000
