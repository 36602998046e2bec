"""Prefix trie of conversations: sharded z-fast tries, edges expanded to one row a node.

A node at depth d is a distinct sequence of first d turns (role, text); its members are the
conversations that start with it.

1. Turns become narrow rows (128-bit digest of role and text, text bytes) in one scan.
   They are sorted by conversation and turn and streamed into one row a conversation: the
   digests as one sequence of 16-byte symbols.  A conversation may take its first turns
   from another one (``base``, ``head``).
2. Equal sequences, sorted and streamed, become one row with the number of members, the
   smallest id and the hash of all ids; a sequence that a third of all conversations have
   is one row from here on.
3. Sequences are dealt to shards by ranges between split sequences, so a first turn that
   very many share spreads over shards.  Each shard builds a z-fast trie: compacted nodes are found by
   the hash of their extent's prefix at the two-fattest depth of their edge.  Batches are
   inserted together: each sequence's exit node is located by fat binary search, in as
   many look-ups as the depth has bits, then the batch splits edges and adds leaves.
4. Edges are expanded to nodes.  A node that is a proper prefix of one of the shard's two
   splits may have members elsewhere; those partial rows (at most 2 * ``SPLIT_TURNS`` a shard,
   whatever the input) are summed over the shards, all others are final.

Defined results: null role or text counts as empty; rows without a ``conv_id`` belong to no
conversation.  Turns are ordered by ``turn`` (null first), equal ones by role, then by digest;
repeated rows are repeated turns.  Conversations without turns are members of the root.  An
empty table has no nodes.  Other columns are not read.  Sequences are equal where their
128-bit digests are.  A conversation's digests and sizes (24 bytes a turn) must fit one row (2 GB).
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisort.llm.common import bound_arrow, drop_stored, shuffle_partitions, stored

SYMBOL = 16
#: Splits are cut to so many turns, so partial rows and the driver's list of splits are bounded.
SPLIT_TURNS = 64
SPLIT_SAMPLE = 8
SHARD_BYTES = 32 << 20
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

SEQUENCE = "conv_id long, seq binary, sizes binary"
MEMBERS = "seq binary, sizes binary, n long, conv_id long, ends string"
NODE = ("prefix binary, depth long, conv_id long, parent_conv_id long, up binary, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends string, bytes long")
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ------------------------------------------------------------------ the trie

def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] divisible by the largest power of two."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


def shared_symbols(x: bytes, y: bytes, start: int, stop: int) -> int:
    """Length in symbols of the longest common prefix within ``stop``, the first ``start`` known equal."""
    low, high = start, stop
    while low < high:  # equality of prefixes is monotone
        mid = (low + high + 1) // 2
        if x[low * SYMBOL:mid * SYMBOL] == y[low * SYMBOL:mid * SYMBOL]:
            low = mid
        else:
            high = mid - 1
    return low


class Node:
    __slots__ = ("start", "end", "rep", "parent", "children", "row")

    def __init__(self, start: int, end: int, rep: int, parent: "Node | None", row: int = -1):
        self.start, self.end, self.rep, self.parent, self.row = start, end, rep, parent, row
        self.children: dict[bytes, Node] = {}


class ZFastTrie:
    """Compacted trie of distinct sequences of 16-byte symbols.

    A node's extent is the first ``end`` symbols of sequence ``rep``; its edge covers depths
    (start, end].  ``handles`` maps (f, hash of the first f symbols) to the node whose edge's
    two-fattest depth is f; the root (end 0) has no edge and no handle."""

    def __init__(self, sequences: list[bytes]):
        self.seq = sequences
        self.root = Node(0, 0, -1, None)
        self.nodes = [self.root]
        self.handles: dict[tuple[int, bytes], Node] = {}

    def _handle(self, node: Node) -> tuple[int, bytes]:
        f = two_fattest(node.start, node.end)
        return f, hashlib.md5(memoryview(self.seq[node.rep])[:f * SYMBOL]).digest()

    def _holds(self, node: Node, x: bytes) -> bool:
        """The node's whole extent is a prefix of ``x``."""
        e = node.end * SYMBOL
        return not e or (len(x) >= e and self.seq[node.rep][:e] == x[:e])

    def locate(self, x: bytes, above: Node | None = None) -> Node:
        """The deepest node whose extent is a prefix of ``x``, by fat binary search from ``above``."""
        node = above or self.root
        low, high = node.end, len(x) // SYMBOL
        view = memoryview(x)
        while low < high:
            f = two_fattest(low, high)
            hit = self.handles.get((f, hashlib.md5(view[:f * SYMBOL]).digest()))
            if hit is None:
                high = f - 1
            elif self._holds(hit, x):
                node, low = hit, hit.end
            else:  # x leaves within the edge of this node
                return hit.parent
        return node

    def insert_batch(self, rows) -> None:
        """Inserts sequences by number: all are located first, then edges are split and leaves added.  Nodes above
        a located one may be added meanwhile, but it keeps its extent, so the search goes on from it."""
        for i, node in [(i, self.locate(self.seq[i])) for i in rows]:
            self._insert(i, self.locate(self.seq[i], node))

    def _insert(self, i: int, node: Node) -> None:
        x = self.seq[i]
        size = len(x) // SYMBOL
        if node.end == size:
            node.row = i
            return
        at = x[node.end * SYMBOL:(node.end + 1) * SYMBOL]
        exit_node = node.children.get(at)
        if exit_node is not None:
            m = shared_symbols(x, self.seq[exit_node.rep], node.end + 1, min(size, exit_node.end))
            node = self._split(exit_node, m)
            if m == size:
                node.row = i
                return
            at = x[m * SYMBOL:(m + 1) * SYMBOL]
        leaf = Node(node.end, size, i, node, i)
        node.children[at] = leaf
        self._add(leaf)

    def _split(self, node: Node, m: int) -> Node:
        """A new node that ends at depth ``m`` of the node's edge, above it."""
        rep = self.seq[node.rep]
        upper = Node(node.start, m, node.rep, node.parent)
        node.parent.children[rep[node.start * SYMBOL:(node.start + 1) * SYMBOL]] = upper
        upper.children[rep[m * SYMBOL:(m + 1) * SYMBOL]] = node
        del self.handles[self._handle(node)]
        node.start, node.parent = m, upper
        self.handles[self._handle(node)] = node
        self._add(upper)
        return upper

    def _add(self, node: Node) -> None:
        self.nodes.append(node)
        self.handles[self._handle(node)] = node


# ------------------------------------------------------------------ expansion

def expand(seqs: list[bytes], sizes: list[np.ndarray], n: list[int], ids: list[int], ends: list[str],
           splits: tuple[bytes, ...] = (), batch: int = 1024) -> list[tuple]:
    """Rows (schema NODE) of all nodes of the trie of ``seqs``.

    ``prefix`` is set on partial rows only: the root and proper prefixes of ``splits``.  Their child figures
    count final children alone.  ``up`` is the prefix of a final row's parent where that is partial."""
    trie = ZFastTrie(seqs)
    for s in range(0, len(seqs), batch):
        trie.insert_batch(range(s, min(s + batch, len(seqs))))
    deepest_first = sorted(trie.nodes, key=lambda v: -v.end)  # children before their parents
    count = {id(v): 0 for v in trie.nodes}
    least: dict[int, int | None] = {id(v): None for v in trie.nodes}
    for v in deepest_first:
        if v.row >= 0:
            count[id(v)] += n[v.row]
            least[id(v)] = _smaller(least[id(v)], ids[v.row])
        if v.parent is not None:
            count[id(v.parent)] += count[id(v)]
            least[id(v.parent)] = _smaller(least[id(v.parent)], least[id(v)])

    below = {id(v): [0, 0, 0] for v in trie.nodes}  # final children, leaves and saved bytes of their subtrees
    out: list[tuple] = []
    for v in deepest_first:
        kids, leaves, saved = below[id(v)]
        members, first = count[id(v)], least[id(v)]
        sha = ends[v.row] if v.row >= 0 else None
        if v is trie.root:
            out.append((b"", 0, first, None, None, members, kids, leaves, saved, sha, 0))
            continue
        rep, size = seqs[v.rep], sizes[v.rep]
        cut = max((min(shared_symbols(rep, s, 0, min(len(rep), len(s)) // SYMBOL), len(s) // SYMBOL - 1) for s in splits),
                  default=0)
        for t in range(v.end, v.start, -1):
            here, ended = int(size[t - 1]), sha if t == v.end else None
            if t <= cut:
                out.append((rep[:t * SYMBOL], t, first, None, None, members, kids, leaves, saved, ended, here))
                kids = leaves = saved = 0  # a partial child is counted when all shards are known
                continue
            leaves = leaves if kids else 1
            saved += (members - 1) * here
            up = rep[:(t - 1) * SYMBOL] if t - 1 <= cut else None
            parent = None if up is not None else least[id(v.parent)] if t == v.start + 1 else first
            out.append((None, t, first, parent, up, members, kids, leaves, saved, ended, here))
            kids = 1
        for k, x in enumerate((kids, leaves, saved)):
            below[id(v.parent)][k] += x
    return out


def _smaller(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def fold_partial(rows: list[dict]) -> list[dict]:
    """Whole rows of the partial nodes (one a prefix, summed over the shards): figures of partial children are added,
    deepest first."""
    by = {bytes(r["prefix"]): r for r in rows}
    for prefix in sorted(by, key=len, reverse=True):
        r = by[prefix]
        r["n_leaves"] = r["n_leaves"] if r["n_children"] else 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["bytes"]
        if prefix:
            up = by[prefix[:-SYMBOL]]
            r["parent_conv_id"] = up["conv_id"]
            up["n_children"] += 1
            up["n_leaves"] += r["n_leaves"]
            up["saved_tokens"] += r["saved_tokens"]
    return list(by.values())


# ------------------------------------------------------------------ streams of sorted rows

def _runs(batches, key: str) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """(key, first piece of its run, rows) over sorted batches; a run may come in several pieces."""
    last, started = None, False
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key)
        values = np.asarray(k.to_pylist(), dtype=object)
        cuts = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            new = not started or values[s] != last
            last, started = values[s], True
            yield last, new, b.slice(s, e - s)


def _emit(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``limit`` bytes."""
    buffer, size = [], 0
    for r in rows:
        buffer.append(r)
        size += sum(len(x) if isinstance(x, (bytes, str)) else 8 for x in r)
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), types)], names=names)
            buffer, size = [], 0
    if buffer:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), types)], names=names)


def _digests(b: pa.RecordBatch) -> tuple[bytes, np.ndarray]:
    fixed = b.column("digest").cast(pa.binary(SYMBOL))
    start = fixed.offset * SYMBOL
    return fixed.buffers()[1].to_pybytes()[start:start + len(fixed) * SYMBOL], b.column("bytes").to_numpy()


def _rebuilt(batches, borrowed: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(conv_id, digests, sizes) from turns sorted by (base, is_base first, conv_id, turn).  The first ``borrowed`` turns of
    the base conversation are held for the others of its group."""
    base_key, base = None, (b"", np.zeros(0, np.int64))
    current, parts = None, []

    def whole():
        seq = b"".join(p for p, _ in parts)
        size = np.concatenate([x for _, x in parts])
        conv, group, head, is_base = current
        own = (seq, size)
        if is_base:
            held = (seq[:borrowed * SYMBOL], size[:borrowed])
        else:
            held = base if base_key == group else (b"", np.zeros(0, np.int64))
            h = max(0, head)
            own = (held[0][:h * SYMBOL] + seq[h * SYMBOL:], np.concatenate([held[1][:h], size[h:]]))
        return (conv, own[0], own[1].astype("<i8").tobytes()), group, held

    for conv, new, b in _runs(batches, "conv_id"):
        if new and current is not None:
            row, base_key, base = whole()
            yield row
        if new:
            group, head, is_base = (b.column(c)[0].as_py() for c in ("base", "head", "is_base"))
            current, parts = (conv, group, head, is_base), []
        parts.append(_digests(b))
    if current is not None:
        yield whole()[0]


def _members(batches) -> Iterator[tuple[bytes, bytes, int, int, str]]:
    """(seq, sizes, members, smallest id, hash of all ids) from sequences sorted by (seq, conv_id)."""
    held = None
    for seq, new, b in _runs(batches, "seq"):
        ids = b.column("conv_id").to_pylist()
        if new:
            if held is not None:
                yield (*held[:4], held[4].hexdigest())
            held = [seq, b.column("sizes")[0].as_py(), 0, ids[0], hashlib.sha256()]
        held[4].update(("," * (held[2] > 0) + ",".join(map(str, ids))).encode())
        held[2] += len(ids)
    if held is not None:
        yield (*held[:4], held[4].hexdigest())


# ------------------------------------------------------------------ the job

def sequences(conversations: DataFrame, base: Column | None = None, head: Column | None = None, borrowed: int = 8,
              id_col: str = "conv_id") -> DataFrame:
    """(conv_id, seq, sizes): turn digests and text bytes of every conversation, in order.

    With ``base`` and ``head`` the first ``head`` turns (at most ``borrowed``) are those of conversation ``base``, as it
    stands in the table (all if it has fewer, none if it is absent), in place of the conversation's own."""
    spark = conversations.sparkSession
    bound_arrow(spark)
    conv = F.col(id_col).cast("bigint")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text)))
    group = conv if base is None else base.cast("bigint")
    first = F.least((F.lit(0) if head is None else head).cast("int"), F.lit(borrowed))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        conv.alias("conv_id"), group.alias("base"), first.alias("head"), (group == conv).alias("is_base"), F.col("turn").alias("turn"),
        role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))
    order = [F.col("base"), F.desc("is_base"), F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]
    rows = (rows.repartition(shuffle_partitions(spark), "base").sortWithinPartitions(*order)
            .select("conv_id", "base", "head", "is_base", "digest", "bytes"))

    def run(batches):
        yield from _emit(_rebuilt(batches, borrowed), ["conv_id", "seq", "sizes"], [pa.int64(), pa.binary(), pa.binary()])

    return rows.mapInArrow(run, SEQUENCE)


def _splits(members: DataFrame, shards: int, total: int) -> list[bytes]:
    """At most ``shards`` - 1 split sequences, from a sample of some ``SPLIT_SAMPLE`` a shard, drawn by hash."""
    share = min(1.0, SPLIT_SAMPLE * shards / max(1, total))
    sample = members.where(F.pmod(F.xxhash64("seq"), F.lit(1 << 30)) < share * (1 << 30))
    heads = sorted(bytes(r[0]) for r in sample.select(F.substring("seq", 1, SPLIT_TURNS * SYMBOL)).collect())
    return sorted({heads[len(heads) * k // shards] for k in range(1, shards)} - {b""}) if heads else []


def prefix_trie(conversations: DataFrame, base: Column | None = None, head: Column | None = None, borrowed: int = 8,
                id_col: str = "conv_id", shards: int | None = None) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  See ``sequences`` for ``base`` and ``head``.  ``shards``: number of shards
    (default: by conversations and bytes)."""
    spark = conversations.sparkSession
    seqs = sequences(conversations, base, head, borrowed, id_col)
    seqs = seqs.repartition(shuffle_partitions(spark), "seq").sortWithinPartitions("seq", "conv_id")

    def distinct(batches):
        types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
        yield from _emit(_members(batches), ["seq", "sizes", "n", "conv_id", "ends"], types)

    members = stored(seqs.mapInArrow(distinct, MEMBERS), "trie-members")
    size = members.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("seq") + F.length("sizes")).alias("b")).first()
    total, n_bytes = int(size["n"]), int(size["b"] or 0)
    if shards is None:
        shards = max(min(shuffle_partitions(spark), total // 64), math.ceil(n_bytes / SHARD_BYTES), 1)
    splits = _splits(members, shards, total)
    shared = spark.sparkContext.broadcast(splits)  # at most shards * SPLIT_TURNS * 16 bytes

    def deal(batches):
        for b in batches:
            at = [bisect.bisect_right(shared.value, x) for x in b.column("seq").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=[*b.schema.names, "shard"])

    fields = [x.split()[0] for x in NODE.split(", ")]
    types = [{"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in NODE.split(", ")]

    def build(table: pa.Table) -> pa.Table:
        k = table.column("shard")[0].as_py()
        near = tuple(shared.value[max(0, k - 1):k + 1])  # the splits below and above the shard
        rows = expand(table.column("seq").to_pylist(), [np.frombuffer(x, "<i8") for x in table.column("sizes").to_pylist()],
                      table.column("n").to_pylist(), table.column("conv_id").to_pylist(), table.column("ends").to_pylist(), near)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=fields)

    nodes = stored(members.mapInArrow(deal, MEMBERS + ", shard int").groupBy("shard").applyInArrow(build, NODE), "trie-nodes")
    partial = (nodes.where(F.col("prefix").isNotNull()).groupBy("prefix")
               .agg(F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
                    F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                    F.sum("saved_tokens").alias("saved_tokens"), F.max("ends").alias("ends"), F.max("bytes").alias("bytes"))
               .withColumn("parent_conv_id", F.lit(None).cast("long")))
    columns = partial.columns

    def fold(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(fold_partial(table.to_pylist()), schema=table.schema)

    # at most 2 * SPLIT_TURNS rows a shard, however many conversations
    whole = stored(partial.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(
        lambda t: fold(t.select(columns)), partial.schema), "trie-partial")
    drop_stored(members)
    above = whole.select(F.col("prefix").alias("up"), F.col("conv_id").alias("_above"))
    final = (nodes.where(F.col("prefix").isNull()).join(F.broadcast(above), "up", "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    both = final.select(*out).unionByName(whole.select(*out))
    return both.withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY_SHA))).select(*RESULT)


__all__ = ["prefix_trie", "sequences", "ZFastTrie", "expand"]
