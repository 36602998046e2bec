import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from conftest import SF_SMALL
from lumisort.llm import queries, templates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mask(line):
    return tuple("<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line))


def known_by(line, min_tokens):
    """(varies, tokens): how a line is recognised; None without a token."""
    own, m = tuple(WORD.findall(line)), mask(line)
    vary = len(m) >= min_tokens and 2 * m.count("<*>") <= len(m)
    return (vary, m if vary else own) if own else None


def alike(a, b):
    return sum(x == y for x, y in zip(a, b)) / len(a)


def brute(docs, depth=3, similarity=0.7, min_tokens=2, min_merge=6):
    """{(id, text): kept text}: the rules read literally."""
    docs = sorted({(i, t) for i, t in docs if t is not None}, key=lambda d: d[0])
    count = Counter(m for _, t in docs for line in t.split("\n") if (m := known_by(line, min_tokens)))
    common = {m: (count[m], hashlib.md5(" ".join(m[1]).encode()).digest()) for m in count if m[0]}
    buckets, of = defaultdict(list), defaultdict(list)
    for vary, m in count:
        if vary and len(m) >= min_merge:
            rest = len(m) - depth
            parts = min(rest, math.floor(len(m) * (1 - similarity) + 1e-9) + 1)
            for i in range(parts):
                b = (len(m), m[:depth], i, m[depth + i * rest // parts:depth + (i + 1) * rest // parts])
                buckets[b].append((vary, m))
                of[vary, m].append(b)
    seed = {b: max(lines, key=common.get) for b, lines in buckets.items()}
    near = {m: {seed[b] for b in bs if seed[b] != m and alike(m[1], seed[b][1]) >= similarity} for m, bs in of.items()}
    joins = {}
    for m, seeds in near.items():
        templates_ = [s for s in seeds if not near[s]]
        if templates_:
            joins[m] = max(templates_, key=common.get)
    held = defaultdict(set)
    for d in docs:
        for line in d[1].split("\n"):
            if m := known_by(line, min_tokens):
                held[joins.get(m, m)].add(d)
    out = {}
    for d in docs:
        out[d] = "\n".join(line for line in d[1].split("\n") if not (
            (m := known_by(line, min_tokens)) and len(h := held[joins.get(m, m)]) > 1 and min(h, key=lambda x: x[0]) != d))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = templates.drop_recurring_lines(df.withColumnRenamed("text", "body"), text_col="body").collect()
    assert len(got) == len(rows)
    before = dict(rows)
    for r in got:
        assert r.body == (None if before[r.doc_id] is None else want[r.doc_id, before[r.doc_id]])


def test_against_brute_force(spark):
    rng = random.Random(5)
    pool = [f"user {i} logged in from host a{j} at 10:{i}" for i in range(5) for j in range(3)]
    pool += ["the quick brown fox jumps over the lazy dog", "the quick brown fox jumps over the lazy cat",
             "the quick brown cat jumps under a lazy dog", "short line", "one", "", "   ", "1 2 3", "a\tb  c",
             "a b c", "x 1 y 2", "tail\r", "é ü ß"]
    pool += [f"a b c {x} {y} {z} tail end" for x in "pqr" for y in "stu" for z in "vw"]
    rows = [(i, "\n".join(rng.choice(pool + [f"own line {i} of text {k} {'z' * i}" for k in range(9)])
                          for _ in range(rng.randint(0, 12)))) for i in range(60)]
    check(spark, rows + [(100, None), (101, "")])


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute(rows)
    got = queries.QUERIES["op7_template_lines"](spark, SF_SMALL).collect()
    assert len(got) == len(rows) and sum(r.n_dropped for r in got) > 0
    text = dict(rows)
    for r in got:
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id, text[r.doc_id]].encode()).hexdigest()


def test_variable_fields_make_one_template(spark):
    rows = [(i, f"own words of document {'abcdef'[i]}\nuser {i} logged in from host{i} at 10:0{i}") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r._dd_dropped for r in templates.drop_recurring_lines(df).collect()}
    assert got[0] == 0 and all(got[i] >= 1 for i in (1, 2, 3))


def test_short_lines_and_lines_of_numbers(spark):
    rows = [(i, f"Home\n12:30 45 2024 GET\nonly {'abcdef'[i]}\n7 {i}\n---") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in templates.drop_recurring_lines(df).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"only {'abcdef'[i]}\n7 {i}" for i in range(1, 6))


def test_families_of_one_leaf(spark):
    """Lines of many families with the same first tokens; the commonest doesn't hide the others."""
    kinds = [f"click here to {v} the {o} of {w} {p}" for v, o, w, p in zip(
        ["open", "close", "print", "share", "save", "rate"], ["page", "door", "list", "photo", "file", "show"],
        ["our", "your", "his", "her", "its", "my"], ["shop", "house", "pages", "holiday", "project", "evening"])]
    words = "red blue green black white brown pink grey gold silver".split()
    rows = [(i, "\n".join(k.replace(" of ", f" {words[(i + j) % 10]} ") for j, k in enumerate(kinds) for _ in range(1 + (j == 0 and i == 3))))
            for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r._dd_dropped for r in templates.drop_recurring_lines(df).collect()}
    assert got[0] == 0 and all(got[i] >= len(kinds) for i in range(1, 8))
    check(spark, rows)


def test_odd_and_empty_tables(odd_docs, no_docs):
    out = templates.drop_recurring_lines(odd_docs)
    assert out.columns == [*odd_docs.columns, "_dd_lines", "_dd_dropped"]
    got = out.collect()
    assert len(got) == odd_docs.count()
    twice = [r for r in got if r.doc_id == 2]
    assert len(twice) == 2 and twice[0].text == twice[1].text == ""  # document 1, or the one without an id, keeps it
    assert [r.text for r in got if r.doc_id == 3] == [None]
    assert templates.drop_recurring_lines(no_docs).count() == 0


def test_plan_has_no_python(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = templates.drop_recurring_lines(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
