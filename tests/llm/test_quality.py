import math
import random
import re
from collections import Counter

import public_tokenizers
import sentencepiece

from conftest import SF_SMALL
from lumisort.llm import quality, queries

MODEL = public_tokenizers.path(queries.PIECE_MODEL)


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(inside), words


def test_query_against_brute_force(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op10_tokeniser_fertility"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        n, chars, sym, dup, rep, words = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, sym, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        ids = [t for w in words for t in sp.encode(w)]
        assert r.n_tokens == len(ids)
        if ids:
            k = Counter(ids)
            entropy = -sum(v / len(ids) * math.log2(v / len(ids)) for v in k.values())
            assert abs(r.token_entropy - entropy) < 1e-9 and abs(r.chars_per_token - chars / len(ids)) < 1e-12
            assert abs(r.byte_share - sum(sp.is_byte(t) for t in ids) / len(ids)) < 1e-12
        band = quality.BANDS[r.script]
        assert r.kept == (not r.base_failed and band.holds(r.chars_per_token, r.byte_share, r.token_entropy, sym / n))


def test_good_labels_are_kept(spark):
    got = queries.QUERIES["op10_tokeniser_fertility"](spark, SF_SMALL).where("not base_failed")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1")
    assert got.join(labels, "doc_id").where("not kept").count() == 0
    assert got.where("not kept").count() > 0


def test_base_counts_on_random_texts():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab \n#\t\x0b\x85é|") for _ in range(rng.randint(0, 60)))
        words, *counts = quality.base_counts(text)
        n, *other, w = brute(text)
        assert (len(words), words, counts) == (n, w, other)


def test_scripts():
    assert quality.script_of("abc déjà") == "latin"
    assert quality.script_of("привет мир") == "cyrillic"
    assert quality.script_of("中文字 abc") in ("cjk", "latin")
    assert quality.script_of("123 ...") == "none"


def test_odd_and_empty_tables(odd_docs, no_docs):
    rows = quality.quality_rules(odd_docs, MODEL).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_words == 0 and by_id[3].base_failed and not by_id[3].kept
    assert by_id[6].n_words == 1 and by_id[7].n_words == 20_000
    assert quality.quality_rules(no_docs, MODEL).count() == 0
    kept = quality.keep_good(odd_docs, MODEL)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)


def test_bands_by_language(odd_docs):
    never = quality.Band(100.0, 200.0, 0.0, 0.0)
    got = quality.quality_rules(odd_docs, MODEL, lang_col="lang", bands={"en": never})
    assert got.where("kept and doc_id in (1, 2)").count() == 0
