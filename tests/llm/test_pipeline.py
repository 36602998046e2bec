import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from conftest import SF_SMALL
from llm import test_minhash, test_templates
from lumisort.llm import bpe, quality, queries


def test_stages_against_brute_force(spark):
    """Each stage on what the one before kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    bad = quality.quality_rules(docs, P.path(queries.PIECE_MODEL)).where("not kept").collect()
    want = {i: t for i, t in rows.items() if i not in {r.doc_id for r in bad}}
    stages = dict(corpus_pipeline.STAGES)

    docs = corpus_pipeline.stored(stages["quality"](spark, docs, SF_SMALL), "t1")
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == want

    shorter = test_templates.brute(list(want.items()))
    want = {i: shorter[i, t] for i, t in want.items() if shorter[i, t].strip(" \n\t\r\x0b\x0c")}
    docs = corpus_pipeline.stored(stages["lines"](spark, docs, SF_SMALL), "t2")
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == want
    assert docs.where("n_chars <> length(text)").count() == 0

    near = test_minhash.brute(list(want.items()))
    want = {i: t for i, t in want.items() if near[i][1] == i}
    docs = corpus_pipeline.stored(stages["near_duplicates"](spark, docs, SF_SMALL), "t3")
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == want

    mixed = corpus_pipeline.stored(stages["mixing"](spark, docs, SF_SMALL), "t4")
    got = {r.doc_id: r.text for r in mixed.collect()}
    assert mixed.columns == columns and set(got.items()) <= set(want.items())
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    toxic = [i for i in want if i in labels and labels[i].toxic == 1]
    clean = [i for i in want if i in labels and labels[i].toxic == 0 and labels[i].quality == 1]
    assert sum(i in got for i in clean) > 0.95 * len(clean) and sum(i in got for i in toxic) < len(toxic)

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(queries.BYTE_RANKS)),
                                special_tokens={})
    for r in stages["encode"](spark, mixed, SF_SMALL).collect():
        ids = library.encode_ordinary(got[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs.columns
            docs = corpus_pipeline.stored(stage(spark, docs, SF_SMALL), f"odd-{name}")
            assert docs.columns == before
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()


def test_run_is_registered(spark):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    ops = {int(q[2:].split("_")[0]) for q in __spark_entry__.queries() if q.startswith("op")}
    assert ops == set(range(1, 14))
