"""Questions that chunks of documents ask about all other chunks, in rounds.

Documents are dealt into chunks of bounded size by a hash.  In each round every
chunk derives a sorted table of entries (64-bit keys, with values) from its texts
and the answers so far; entries go to buckets by key, a bucket sees the entries of
one key from all chunks together and answers each with a small code, and the codes
go back to their chunk.  A key that a third of all documents hold is one entry a
chunk, so no bucket grows with a key's frequency, and no text is moved again after
the chunks are dealt.

A ``Job`` (plain Python, sent to the workers) says what the entries of each round
are, how a bucket answers, and what a chunk returns in the end.  Entries and answers
are packed, one row per chunk and bucket.  Chunks are persisted while the rounds
run and can be computed again from the input; answers are written to the shared
folder, so a lost executor costs the chunks it held.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisort.llm.common import bound_arrow, drop_stored, shuffle_partitions, stored

CHUNK_BYTES = 8 << 20
ASK = "round int, kind int, chunk bigint, bucket bigint, payload binary"


class Job:
    """What chunks ask. Methods run in Python workers and must be deterministic."""

    rounds = 0
    result = ""  # SQL schema of the rows of ``finish``

    def derive(self, ids: list, texts: list[bytes]) -> Any:
        """State of a chunk; documents come sorted by id and text."""
        raise NotImplementedError

    def ask(self, state: Any, round_: int) -> dict[int, tuple[np.ndarray, Any]]:
        """kind -> (key of each entry, anything ``pack`` understands)."""
        raise NotImplementedError

    def pack(self, round_: int, kind: int, entries: Any, which: np.ndarray) -> bytes:
        raise NotImplementedError

    def answer(self, round_: int, kind: int, payloads: list[bytes]) -> list[np.ndarray]:
        """One array of codes per payload, a code per entry."""
        raise NotImplementedError

    def heard(self, state: Any, round_: int, codes: dict[int, np.ndarray]) -> None:
        """Takes in the answers of a round, aligned with what ``ask`` gave."""
        raise NotImplementedError

    def finish(self, state: Any) -> dict[str, pa.Array]:
        """Columns of ``result``, a row per document."""
        raise NotImplementedError


def in_buckets(keys: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Places of the keys of each bucket, in their order."""
    b = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    return np.split(order, np.searchsorted(b[order], np.arange(1, buckets)))


def _state(job: Job, chunk: pa.Table, answers: pa.Table | None, upto: int, buckets: int) -> Any:
    ids, texts = chunk.column("id").to_pylist(), chunk.column("text").to_pylist()
    order = sorted(range(chunk.num_rows), key=lambda i: (ids[i], texts[i]))
    state = job.derive([ids[i] for i in order], [texts[i] for i in order])
    got: dict[tuple, bytes] = {}
    if answers is not None:
        for r, k, b, payload in zip(*(answers.column(c).to_pylist() for c in ("round", "kind", "bucket", "payload"))):
            got[r, k, b] = payload
    for r in range(upto):
        codes = {}
        for kind, (keys, _) in job.ask(state, r).items():
            code = np.zeros(len(keys), np.uint16)
            for b, which in enumerate(in_buckets(keys, buckets)):
                if len(which):
                    code[which] = np.frombuffer(got[r, kind, b], np.uint16)
            codes[kind] = code
        job.heard(state, r, codes)
    return state


def run_rounds(df: DataFrame, job: Job, id_col: str, text_col: str, name: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``job.finish`` of all chunks, stored.  Rows without an id or text don't take part."""
    spark = df.sparkSession
    bound_arrow(spark)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull())
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(shuffle_partitions(spark), math.ceil(total / chunk_bytes))
    buckets = max(1, min(chunks, 4 * math.ceil(total / chunk_bytes)))
    # with the number of the partition read, so that rows that repeat spread too
    docs = (docs.withColumn("chunk", F.pmod(F.xxhash64("id", "text", F.spark_partition_id()), F.lit(chunks)))
            .repartition(chunks, "chunk").persist(StorageLevel.MEMORY_AND_DISK))
    answers, tables = None, []
    try:
        for r in range(job.rounds):
            asked = _each(docs, answers, _asking(job, r, buckets), ASK)
            new = asked.groupBy("kind", "bucket").applyInArrow(_answering(job, r), ASK)
            new = stored(new, f"{name}-answers")
            tables.append(new)
            answers = new if answers is None else answers.unionByName(new)
        return stored(_each(docs, answers, _finishing(job, buckets), job.result), name)
    finally:
        docs.unpersist()
        drop_stored(*tables)


def _each(docs: DataFrame, answers: DataFrame | None, f, schema: str) -> DataFrame:
    if answers is None:
        return docs.groupBy("chunk").applyInArrow(lambda t: f(t, None), schema)
    return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lambda t, a: f(t, a), schema)


def _asking(job: Job, r: int, buckets: int):
    def ask(chunk: pa.Table, answers: pa.Table | None) -> pa.Table:
        rows = []
        if chunk.num_rows:
            number = chunk.column("chunk")[0].as_py()
            state = _state(job, chunk, answers, r, buckets)
            for kind, (keys, entries) in job.ask(state, r).items():
                rows += [(r, kind, number, b, job.pack(r, kind, entries, which))
                         for b, which in enumerate(in_buckets(keys, buckets)) if len(which)]
        return _rows(rows)
    return ask


def _answering(job: Job, r: int):
    def answer(asked: pa.Table) -> pa.Table:
        kind, bucket = asked.column("kind")[0].as_py(), asked.column("bucket")[0].as_py()
        order = sorted(range(asked.num_rows), key=(chunk := asked.column("chunk").to_pylist()).__getitem__)
        payload = asked.column("payload").to_pylist()
        codes = job.answer(r, kind, [payload[i] for i in order])
        return _rows([(r, kind, chunk[i], bucket, c.astype(np.uint16).tobytes()) for i, c in zip(order, codes)])
    return answer


def _finishing(job: Job, buckets: int):
    def finish(chunk: pa.Table, answers: pa.Table | None) -> pa.Table:
        if not chunk.num_rows:
            return pa.table(job.finish(job.derive([], [])))
        return pa.table(job.finish(_state(job, chunk, answers, job.rounds, buckets)))
    return finish


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["round", "kind", "chunk", "bucket", "payload"])
