import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from lumisort.llm import langid, queries


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op1_kneser_ney"](spark, SF_CHECK)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert got.count() == docs.count()
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    joined = got.join(docs.select("doc_id", "lang", fold.alias("fold")), "doc_id")
    assert joined.where("held_out <> fold").count() == 0
    held = joined.where("held_out and lang is not null")
    assert held.where("lang_pred = lang").count() / held.count() > 0.97
    assert joined.where("score < 0 or score > 1").count() == 0
    assert held.where("rejected").count() / held.count() < 0.05


def slow_probability(counts, text, lang_counts_order=langid.ORDER):
    """p(last | context) of a gram by the textbook recursion over dictionaries."""
    grams = {}
    for g, c in counts.items():
        grams.setdefault(len(g), {})[g] = c
    top = lang_counts_order
    level = {top: grams[top]}
    for n in range(top - 1, 0, -1):
        level[n] = {}
        for g in level[n + 1]:
            level[n][g[1:]] = level[n].get(g[1:], 0) + 1
    alphabet = len(level[1]) + 1

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / alphabet
        table = level[n]
        n1, n2 = sum(c == 1 for c in table.values()), sum(c == 2 for c in table.values())
        d = min(max(n1 / (n1 + 2 * n2), 0.05), 0.95) if n1 + n2 else 0.5
        after = {k: c for k, c in table.items() if k[:-1] == g[:-1]}
        lower = p(g[1:])
        if not after:
            return lower
        total = sum(after.values())
        return (table[g] - d if g in table else 0.0) / total + d * len(after) / total * lower

    return p(text)


def test_model_is_interpolated_kneser_ney():
    text = "the cat sat on the mat and the rat ate the oat"
    keys, counts = np.unique(langid.grams(langid.letters(text)), return_counts=True)
    model = langid.build_model({"x": (keys, counts)})
    raw = {}
    padded = " " * (langid.ORDER - 1) + text + " "
    for i in range(len(padded) - langid.ORDER + 1):
        g = padded[i:i + langid.ORDER]
        raw[g] = raw.get(g, 0) + 1
    for gram in ("the ", " cat", "zzzz", "athe", "on z"):
        key = langid.grams(np.array([ord(c) for c in gram], np.uint16))
        assert model.probability(0, key)[0] == pytest.approx(slow_probability(raw, gram), rel=1e-9)
    whole = sum(model.probability(0, langid.grams(np.array([ord(c) for c in "the" + x], np.uint16)))[0]
                for x in sorted(set(padded)))
    assert 0.9 < whole <= 1.0 + 1e-9


def test_odd_and_empty_tables(odd_docs, no_docs):
    model = langid.fit(odd_docs)
    got = langid.predict(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got}
    for i in (3, 4, 5, 9):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0 and by_id[i].rejected
    assert by_id[8].lang_pred in ("en", "de", "fr")
    nothing = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.predict(odd_docs, nothing).collect()} == {"und"}
    assert langid.predict(no_docs, model).count() == 0


def test_letters_fold():
    assert "".join(map(chr, langid.letters("Ab1, ÉC!"))) == "   ab éc "
    assert len(langid.letters("123 !")) == 0
    assert len(langid.letters("\U00010400\U00010401")) > 0


def test_copies_and_scarce_languages(spark):
    """The bound holds over distinct texts, no language is lost, copies weigh nothing."""
    rng = np.random.default_rng(2)
    words = {"de": ["haus", "und", "nicht", "strasse", "grün"], "fr": ["maison", "et", "pas", "rue", "vert"]}
    rows = [(" ".join(rng.choice(words[x], 12)) + f" {'abcdefghij'[i % 10]}{'klmnop'[i % 6]}{'qrst'[i % 4]}" * 2, x)
            for x in ("de", "fr") for i in range(600)]
    rows += [("το σπίτι και ο δρόμος", "el")] + [("одна улица", "ru")] * 3
    df = spark.createDataFrame(rows, "text string, lang string").unionByName(
        spark.range(20_000).select(F.lit("ein einziger text").alias("text"), F.lit("de").alias("lang")))
    sample = langid._sample(df, 100, 0.1)
    got = {r.lang: (r.n, r.kept) for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n"),
                                                                     F.count_if("kept_out").alias("kept")).collect()}
    assert got["de"] == got["fr"] == (100, 10) and got["el"] == got["ru"] == (1, 0)
    assert sample.where("text = 'ein einziger text'").count() <= 1
    model = langid.fit(df, rows_per_language=100)
    assert model.langs == ["de", "el", "fr", "ru"]
    texts = ["grün und haus", "rue et maison", "ο δρόμος", "улица", "\u0301\u0300\u0308", "\u0301 12"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    by_id = {r.doc_id: r for r in langid.predict(asked, model).collect()}
    assert [by_id[i].lang_pred for i in range(6)] == ["de", "fr", "el", "ru", "und", "und"]
    assert all(by_id[i].score == 0 and by_id[i].rejected for i in (4, 5))
