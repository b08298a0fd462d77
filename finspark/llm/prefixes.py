"""Prefix trie of conversations with a splitter skeleton (operator 13).

A node is a distinct sequence of first turns (role, text); its members are
the conversations that start with it. Conversations become paths of 16-byte
turn hashes, kept with their words a turn; texts stay where they are. Sorted
by path, the members of a node are neighbours, so:

1. Splitters, drawn from a sample of (path, conv_id), cut the order into
   shards of about equal rows. Equal paths are cut by conv_id, so a
   conversation that a third of all repeat is spread as well. The sample
   decides balance alone, never a result.
2. Skeleton. A node whose members lie in two shards is a prefix of a
   splitter's path. The trie of the splitters' paths is broadcast; its size,
   shards times a path, is checked (``MOST_SKELETON_BYTES``).
3. Each shard, sorted, is read once with a stack of open nodes. All nodes
   but the skeleton's begin and end inside and are finished there; of
   skeleton nodes a shard gives partial counts.
4. Reduction. Partial counts of a skeleton node are summed by a grouped
   aggregate; sums over subtrees run over the reduced skeleton, a row for
   each of its nodes, from the leaves up.
5. Ids of conversations that end at a node are hashed in order: in the shard,
   or, for skeleton nodes, from the shards' ordered pieces as a stream.

A task holds one shard, whose size does not grow with the corpus, and one
path of 24 bytes a turn at least; the hash of one node's ids is by its nature
computed by one reader, in pieces of ``PIECE`` ids.

Defined results: null role or text is empty; turns of equal number come in
the order of their hash, repeated rows are turns of their own; rows without a
conv_id belong to no conversation; an empty table has no node; words are runs
of anything but blanks; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, stored

WIDTH = 16  # bytes of a turn's hash
#: Conversations of a shard (about); sampled rows a shard; ids of a piece.
SHARD_ROWS, SAMPLED, PIECE = 50_000, 16, 100_000
MOST_SKELETON_BYTES = 64 << 20
# Kinds of a shard's rows: a finished node with its parent known, one whose
# parent is a skeleton node, a partial skeleton node, a piece of ids.
NODE, BELOW, PARTIAL, IDS = 0, 1, 2, 3
COUNTS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
SHARD = pa.schema([("kind", pa.int32()), ("skeleton", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("tokens", pa.int64()),
                   ("ends_sha256", pa.string()), ("ids", pa.binary())])
SHARD_DDL = ("kind int, skeleton bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
             + ", tokens bigint, ends_sha256 string, ids binary")


def turn_paths(turns: DataFrame) -> DataFrame:
    """conv_id, turns: (turn, hash, words) of each conversation in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"),
                                                      F.struct(F.col("turn").alias("turn"), key.alias("key"), words.alias("tokens")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def shared_heads(paths: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations with the first h turns of their group's conversation
    (conv_id - conv_id % every) in place of their own first h, where h is the
    crc32 of the id's decimal digits modulo ``most``."""
    c = F.col("conv_id")
    heads = (paths.filter(c % every == 0).select(c.alias("_base"), F.slice("turns", 1, most - 1).alias("_head")))
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(most)).cast("int")
    n = F.size("turns")
    head = F.when(F.col("_head").isNull(), F.lit(None)).otherwise(F.slice("_head", F.lit(1), h))
    tail = F.when(n > h, F.slice("turns", h + 1, F.greatest(n - h, F.lit(1))))
    none = F.slice("turns", 1, 0)
    return (paths.withColumn("_base", c - c % every).join(heads, "_base", "left")
            .select("conv_id", F.concat(F.coalesce(head, none), F.coalesce(tail, none)).alias("turns")))


def _shard_of(paths: DataFrame, splitters: list[tuple[bytes, int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(splitters, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=[*batch.schema.names, "_shard"])

    return paths.mapInArrow(run, "conv_id bigint, path binary, tokens array<bigint>, _shard int")


def choose_splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards`` - 1 keys that cut the order into like numbers of
    rows, from the rows of smallest hashed id."""
    if shards < 2:
        return []
    drawn = paths.select("path", "conv_id").orderBy(F.xxhash64("conv_id"), "conv_id", "path").limit(SAMPLED * shards)
    size = drawn.agg(F.sum(F.octet_length("path")).alias("n")).first()["n"] or 0
    if size > MOST_SKELETON_BYTES:  # long paths: fewer of them are enough to cut by
        drawn = drawn.limit(max(1, int(SAMPLED * shards * MOST_SKELETON_BYTES / size)))
    keys = sorted({(bytes(r["path"]), r["conv_id"]) for r in drawn.collect()})
    return sorted({keys[len(keys) * i // shards] for i in range(1, shards)}) if keys else []


class Skeleton:
    """The trie of the splitters' paths: node 0 is the root, parents come
    before their children."""

    def __init__(self, paths: list[bytes]):
        if sum(map(len, set(paths))) > MOST_SKELETON_BYTES:
            raise ValueError("splitter paths: too large to send to every task; take fewer shards")
        self.parent, self.child = [-1], [{}]
        for p in sorted(set(paths)):
            at = 0
            for i in range(0, len(p), WIDTH):
                k = p[i:i + WIDTH]
                if k not in self.child[at]:
                    self.child[at][k] = len(self.parent)
                    self.parent.append(at)
                    self.child.append({})
                at = self.child[at][k]

    def children(self) -> np.ndarray:
        return np.array([len(c) for c in self.child], np.int64)


class Open:
    """A node on the stack of the path being read; ``skeleton`` is its number
    there, or -1."""

    __slots__ = ("skeleton", "tokens", "conv", "convs", "children", "leaves", "saved", "ends", "hash", "hashed", "below")

    def __init__(self, skeleton: int, tokens: int):
        self.skeleton, self.tokens = skeleton, tokens
        self.conv, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[int] = []
        self.hash, self.hashed = hashlib.sha256(), False
        self.below: list[list] = []  # children's rows, which want this node's conv_id

    def add(self, conv: int, convs: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.convs += convs


def read_shard(rows: Iterator[tuple[int, bytes, list[int]]], skeleton: Skeleton) -> Iterator[tuple]:
    """SHARD rows from a shard's (conv_id, path, tokens) in order."""
    stack: list[Open] = []

    def give_ends(node: Open) -> Iterator[tuple]:
        if node.ends and node.skeleton >= 0:
            yield (IDS, node.skeleton, node.ends[0], *[None] * 8, np.array(node.ends, "<i8").tobytes())
        elif node.ends:
            node.hash.update((b"," if node.hashed else b"") + ",".join(map(str, node.ends)).encode())
            node.hashed = True
        node.ends = []

    def give_below(node: Open) -> Iterator[tuple]:
        for r in node.below:
            if node.skeleton < 0:
                r[2] = node.conv
            yield (NODE if node.skeleton < 0 else BELOW, node.skeleton, *r, None)
        node.below = []

    def close() -> Iterator[tuple]:
        depth, node = len(stack) - 1, stack.pop()
        yield from give_ends(node)
        yield from give_below(node)
        if stack:
            stack[-1].add(node.conv, node.convs)
        if node.skeleton >= 0:  # its children there, itself as a leaf and its subtree follow at the reduction
            yield (PARTIAL, node.skeleton, node.conv, depth, None, node.convs, node.children, node.leaves, node.saved, node.tokens,
                   None, None)
            return
        node.leaves += not node.children
        node.saved += (node.convs - 1) * node.tokens
        up = stack[-1]
        up.children += 1
        up.leaves += node.leaves
        up.saved += node.saved
        up.below.append([node.conv, depth, None, node.convs, node.children, node.leaves, node.saved, None, node.hash.hexdigest()])
        if up.skeleton >= 0 and len(up.below) >= PIECE:
            yield from give_below(up)

    before = b""
    for conv, path, tokens in rows:
        if not stack:
            stack.append(Open(0, 0))
        n, common = len(path) // WIDTH, 0
        most = min(len(stack) - 1, n)
        if path == before:
            common = most
        while common < most and path[common * WIDTH:(common + 1) * WIDTH] == before[common * WIDTH:(common + 1) * WIDTH]:
            common += 1
        while len(stack) - 1 > common:
            yield from close()
        for d in range(common, n):
            up = stack[-1].skeleton
            k = skeleton.child[up].get(path[d * WIDTH:(d + 1) * WIDTH], -1) if up >= 0 else -1
            stack.append(Open(k, tokens[d]))
        top = stack[-1]
        top.add(conv, 1)
        top.ends.append(conv)
        if len(top.ends) >= PIECE:
            yield from give_ends(top)
        before = path
    while stack:
        yield from close()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, list[int]]]:
    for b in batches:
        yield from zip(b.column("conv_id").to_pylist(), b.column("path").to_pylist(), b.column("tokens").to_pylist())


def _shards(paths: DataFrame, splitters: list[tuple[bytes, int]], skeleton: Skeleton) -> DataFrame:
    """What every shard, one task each, finishes and gives on."""
    ordered = (_shard_of(paths, splitters).repartitionById(len(splitters) + 1, F.col("_shard"))
               .sortWithinPartitions("_shard", "path", "conv_id").select("conv_id", "path", "tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for r in read_shard(_rows(batches), skeleton):
            out.append(r)
            if len(out) >= 20_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return ordered.mapInArrow(run, SHARD_DDL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SHARD)], schema=SHARD)


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """skeleton, ends_sha256 from pieces ordered by (skeleton, first id)."""
    out, at, h, n = [], None, None, 0
    for b in batches:
        for k, ids in zip(b.column("skeleton").to_pylist(), b.column("ids").to_pylist()):
            if k != at:
                if at is not None:
                    out.append((at, h.hexdigest()))
                at, h, n = k, hashlib.sha256(), 0
            h.update((b"," if n else b"") + ",".join(map(str, np.frombuffer(ids, "<i8").tolist())).encode())
            n += 1
    if at is not None:
        out.append((at, h.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([x for _, x in out], pa.string())],
                                     names=["skeleton", "ends_sha256"])


def _skeleton_nodes(rows: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton's finished nodes: partial counts summed by node, then
    summed up the skeleton (one small row a node) from the leaves."""
    reduced = rows.filter(F.col("kind") == PARTIAL).groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("tokens").alias("tokens"))
    names = ["skeleton", *COUNTS]
    parent, children = skeleton.parent, skeleton.children()

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=None).sort_by("skeleton") if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        at, conv, depth, convs, kids, leaves, saved, tokens = (table.column(c).to_numpy().copy() for c in (
            "skeleton", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "tokens"))
        # every skeleton node has a member, so rows and nodes agree
        assert len(at) == len(parent)
        kids += children
        leaves[kids == 0] = 1
        saved += (convs - 1) * tokens
        for k in range(len(parent) - 1, 0, -1):
            leaves[parent[k]] += leaves[k]
            saved[parent[k]] += saved[k]
        own = np.array(parent)
        up_conv = pa.array(conv[np.maximum(own, 0)], mask=own < 0)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(conv), pa.array(depth), up_conv, pa.array(convs), pa.array(kids),
                                          pa.array(leaves), pa.array(saved)], names=names)

    nodes = reduced.coalesce(1).mapInArrow(up, ", ".join(f"{c} bigint" for c in names))
    pieces = rows.filter(F.col("kind") == IDS).select("skeleton", F.col("conv_id").alias("first"), "ids")
    n = parts_for(rows.sparkSession)
    ends = pieces.repartition(n, "skeleton").sortWithinPartitions("skeleton", "first").mapInArrow(
        _hash_ids, "skeleton bigint, ends_sha256 string")
    empty = F.lit(hashlib.sha256().hexdigest())
    return nodes.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty))


def trie(paths: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie over ``paths`` (conv_id, turns as given by
    :func:`turn_paths`): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    joined: Column = F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")
    flat = stored(paths.select("conv_id", F.unhex(joined).alias("path"), F.transform("turns", lambda t: t["tokens"]).alias("tokens")),
                  "paths")
    n = flat.count()
    shards = max(min(parts_for(flat.sparkSession), -(-n // 1000)), -(-n // shard_rows), 1)
    splitters = choose_splitters(flat, shards)
    skeleton = Skeleton([p for p, _ in splitters])
    rows = stored(_shards(flat, splitters, skeleton), "trie-shards")
    top = stored(_skeleton_nodes(rows, skeleton), "skeleton")
    cols = [*COUNTS, "ends_sha256"]
    below = rows.filter(F.col("kind") == BELOW).drop("parent_conv_id").join(
        F.broadcast(top.select("skeleton", F.col("conv_id").alias("parent_conv_id"))), "skeleton")
    return (rows.filter(F.col("kind") == NODE).select(*cols).unionByName(below.select(*cols))
            .unionByName(top.select(*cols)))
