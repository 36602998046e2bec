import hashlib
import random
import re

import numpy as np
import pytest

from conftest import SF_SMALL
from lumisort.llm import phrases, queries


def brute(docs, n):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    first, out = {}, {}
    for (i, _), w in sorted(zip(docs, words), key=lambda x: x[0][0]):
        for j in range(len(w) - n + 1):
            first.setdefault(tuple(w[j:j + n]), i)
    for (i, _), w in zip(docs, words):
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j:j + n])] < i:
                gone[j:j + n] = [True] * n
        out[i] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)
    return out


@pytest.mark.parametrize("window", [13, 4])
def test_against_brute_force(spark, window):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [rng.choice(vocabulary) for _ in range(400)]
    docs = []
    for i in range(50):
        at = rng.randint(0, 300)
        part = base[at:at + rng.randint(5, 150)]
        for _ in range(rng.randint(0, 3)):
            part[rng.randrange(len(part))] = f"x{rng.randint(0, 9)}"
        docs.append((rng.randint(-10**6, 10**6) * 50 + i,
                     " ".join([rng.choice(vocabulary) for _ in range(rng.randint(0, 20))] + part) + "\n é"))
    docs += [(7, "a " * 60), (8, "a " * 30), (9, "a " * 13), (10, ""), (11, "é\x85ü " * 20), (12, None)]
    got = phrases.remove_repeated_passages(spark.createDataFrame(docs, "doc_id long, text string"), window).collect()
    want = brute(docs, window)
    assert len(got) == len(docs) and sum(x[1] for x in want.values()) > 500
    for r in got:
        assert (r.n_words, sum(s.stop - s.start for s in r.spans), r.kept) == want[r.doc_id]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute(docs, 13)
    got = queries.QUERIES["op4_phrase_automata"](spark, SF_SMALL).collect()
    assert len(got) == len(docs) and sum(r.n_removed for r in got) > 0
    for r in got:
        n, removed, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())


def test_words_as_characters():
    codes = np.array([0, 5, 60_000, 1_000_000, 5, 20_000_000, 127, 128])
    text = phrases.as_characters(codes)
    parts = [text[i:i + phrases.WIDTH] for i in range(0, len(text), phrases.WIDTH)]
    assert len(parts) == 8 and parts[1] == parts[4] and len(set(parts)) == 7
    assert not {p[0] for p in parts} & {p[1] for p in parts}
    text.encode("utf-8")


def test_odd_and_empty_tables(odd_docs, no_docs):
    got = phrases.remove_repeated_passages(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r.doc_id == 2:
            assert r.kept == "" and r.n_words == 150
        if r.doc_id in (1, 3, 4, 5, 6, 7, None):
            assert not r.spans
    assert phrases.remove_repeated_passages(no_docs).count() == 0


def test_words_that_polynomial_hashes_confuse(spark):
    """Thue-Morse words over two letters and their complements agree under polynomial hashes modulo 2^64."""
    word = "a"
    rows, n = [], 0
    for _ in range(13):
        word += word.translate(str.maketrans("ab", "ba"))
        for w in (word, word.translate(str.maketrans("ab", "ba"))):
            rows.append((n, " ".join([*(f"w{k}" for k in range(12)), w])))
            n += 1
    got = phrases.remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 13).collect()
    assert len(got) == n and all(r.spans == [] for r in got)
    assert {r.kept for r in got} == {t for _, t in rows}
