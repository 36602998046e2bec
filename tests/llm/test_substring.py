import hashlib
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from lumisort.llm import cells, queries, substring


def brute(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for j in range(len(t) - length + 1):
            seen.setdefault(t[j:j + length], []).append((i, j))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, j in places:
                gone[i][j:j + length] = True
    return gone


def spans_of(gone):
    cut = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
    return list(zip(cut[::2].tolist(), cut[1::2].tolist()))


def hard_texts(seed):
    rng = random.Random(seed)

    def draw(n, letters):
        return bytes(rng.choice(letters) for _ in range(n))

    base = draw(3000, b"abcdefgh \n")
    out = [base]
    for _ in range(20):
        part = bytearray(base[rng.randint(0, 800):rng.randint(1500, 3000)])
        for _ in range(rng.randint(0, 6)):
            part[rng.randrange(len(part))] = rng.randrange(97, 123)
        out.append(draw(rng.randint(0, 300), b"xyz ") + bytes(part) + draw(rng.randint(0, 300), b"uvw "))
    twin = draw(400, b"ab")
    return out + [b"a" * 1500, b"ab" * 700 + b"c" + b"ab" * 300, b"", draw(399, b"ab"), twin, twin,
                  draw(200, b"pq") + base[100:499] + draw(50, b"rs"), draw(500, b"mn") * 3, bytes(2000)]


@pytest.mark.parametrize("length,hot", [(400, substring.HOT), (400, 1), (60, 2)])
def test_against_brute_force(spark, length, hot):
    texts = hard_texts(length + hot)
    df = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "doc_id long, text binary")
    gone = brute(texts, length)
    got = substring.remove_repeated_bytes(df, length, hot=hot).collect()
    assert len(got) == len(texts) and sum(g.sum() for g in gone) > 1000
    for r in got:
        g = gone[r.doc_id]
        assert [(s.start, s.stop) for s in r.spans] == spans_of(g) and r.n_bytes == len(texts[r.doc_id])
        assert bytes(r.kept) == bytes(np.frombuffer(texts[r.doc_id], np.uint8)[~g])


def test_index_finds_long_matches():
    rng = random.Random(1)
    base = bytes(rng.choice(b"ab") for _ in range(60))
    texts = [base[i:i + 45] for i in (0, 5, 5, 9)] + [bytes(rng.choice(b"abc") for _ in range(50)) for _ in range(20)]
    index = substring.RunLengthIndex(texts, 40)
    windows = [t[j:j + 40] for t in texts for j in range(len(t) - 39)]
    assert index.repeated().tolist() == [windows.count(w) > 1 for w in windows]
    assert index.runs[1].sum() == len(windows) and len(index.samples) == len(index.runs[0])


def test_equal_windows_share_a_core():
    rng = random.Random(3)
    passage = bytes(rng.choice(b"abcd ") for _ in range(700))
    texts = [bytes(rng.choice(b"abcd ") for _ in range(n)) + passage + bytes(rng.choice(b"xyz") for _ in range(300))
             for n in (10, 777)]
    starts = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    r = cells.ranges(data, starts, 400)
    c = cells.cells(data, r["first"], r["last"], r["anchor"], 400)
    core = {}
    for lo, hi, k in zip(c["lo"].tolist(), c["hi"].tolist(), c["core"].tolist()):
        for w in range(lo, hi + 1):
            core[w] = k
    assert set(core) == {starts[i] + j for i in (0, 1) for j in range(len(texts[i]) - 399)}
    for j in range(301):
        assert core[10 + j] == core[starts[1] + 777 + j]


def test_query(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    gone = dict(zip([i for i, _ in docs], brute([t for _, t in docs], 400)))
    text = dict(docs)
    got = queries.QUERIES["op2_run_length_index"](spark, SF_SMALL).collect()
    assert len(got) == len(docs) and sum(r.n_removed for r in got) > 0
    for r in got:
        g = gone[r.doc_id]
        kept = bytes(np.frombuffer(text[r.doc_id], np.uint8)[~g]) if len(g) else b""
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(g), g.sum(), len(spans_of(g)))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_odd_and_empty_tables(odd_docs, no_docs):
    got = substring.remove_repeated_bytes(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r.doc_id in (3, 4, None):
            assert not r.spans
        if r.doc_id in (1, 2):  # copies of each other
            assert bytes(r.kept) == b"" and len(r.spans) == 1
        if r.doc_id == 6:
            assert bytes(r.kept) == b"" and r.spans[0].stop == 50_000
    assert substring.remove_repeated_bytes(no_docs).count() == 0
