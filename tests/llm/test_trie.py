import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lumisort.llm import queries, trie


def brute(rows, rebuild=True):
    """(conv_id, turn, role, text) -> sorted result rows."""
    def key(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, role, hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest())

    turns = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        turns.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    convs = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        convs[c] = tuple(turns.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    kids, leaves, saved = ({p: 0 for p in nodes} for _ in range(3))
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = leaves[p] if kids[p] else 1
        saved[p] += (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        if p:
            kids[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = []
    for p, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(rng, n):
    rows = []
    for c in range(n):
        size = rng.choice([0, 1, 2, 3, 5, 8, 13])
        text = [("hot" if rng.random() < 0.4 else rng.choice("abé")) if d < 2 else rng.choice(["x", "yy", "z\U0001f600"]) for d in range(size)]
        rows += [(c, d, "user" if d % 2 == 0 else "assistant", t) for d, t in enumerate(text)]
    rows += [(c, d, "user", "same") for c in range(1000, 1100) for d in range(20)]  # copies
    rows += [(2000 + k, d, "user", "same" if d < 10 + 7 * k else f"own {k}") for k in range(9) for d in range(80)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [None, 1, 7, 60])
def test_against_brute_force(spark, shards):
    rows = conversations(random.Random(2), 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(trie.prefix_trie(df, shards=shards)) == brute(rows, rebuild=False)


def test_rebuilt_conversations(spark):
    rows = conversations(random.Random(3), 200)
    rows = [r for r in rows if r[0] % 10 != 5]  # some bases are absent
    rows += [(-c, d, "user", f"n{d % 3}") for c in range(1, 30) for d in range(c % 12)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    conv = F.col("conv_id")
    out = trie.prefix_trie(df, base=conv - conv % 5, head=F.crc32(conv.cast("string").cast("binary")) % 9, shards=11)
    assert result(out) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, None, None, None), (1, None, "user", ""), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "bot", "b"),
            (None, 0, "user", "a"), (3, 5, "", ""), (4, -1, "u", "ser"), (4, 7, "us", "er"), (6, 1, "user", "x" * 100_000)]
    df = spark.createDataFrame([(*r, "p", "q", 1) for r in rows], SCHEMA + ", prefix string, seq string, depth int")
    assert result(trie.prefix_trie(df)) == brute(rows, rebuild=False)
    assert trie.prefix_trie(df.where("false")).collect() == []
    assert result(trie.prefix_trie(df.where("conv_id = 3"))) == brute([rows[7]], rebuild=False)


def test_fat_binary_search_needs_few_lookups():
    """Exit nodes are found in as many look-ups as the depth has bits."""
    symbols = [hashlib.md5(bytes([k])).digest() for k in range(4)]
    rng = random.Random(5)
    seqs = sorted({b"".join(rng.choices(symbols, (20, 1, 1, 1), k=rng.randint(1, 200))) for _ in range(500)})
    t = trie.ZFastTrie(seqs)
    for s in range(0, len(seqs), 64):
        t.insert_batch(range(s, min(s + 64, len(seqs))))

    class Counted(dict):
        asked = 0

        def get(self, k, default=None):
            Counted.asked += 1
            return super().get(k, default)

    t.handles = Counted(t.handles)
    for i, s in enumerate(seqs):
        before = Counted.asked
        node = t.locate(s)
        assert node.row == i and node.end * 16 == len(s)
        assert Counted.asked - before <= (len(s) // 16).bit_length() + 1
    assert all(v.children == {} or len(v.children) > 1 or v.row >= 0 for v in t.nodes[1:])  # compacted


def test_query_on_given_table(spark):
    rows = [tuple(r) for r in queries.read_table(spark, SF_SMALL, "conversations").collect()]
    assert result(queries.op12_zfast_trie(spark, SF_SMALL)) == brute(rows)
