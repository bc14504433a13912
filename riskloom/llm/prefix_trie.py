"""Prefix trie of conversations from ternary search trees over range shards.

A turn is a symbol of 20 bytes: 16 of the SHA-256 digest of role and text, then the byte
length of the text. A conversation is the string of its symbols (its path). Paths are
range-partitioned and sorted with the conversation id as last key, so that any number of
copies of one conversation is dealt over several tasks.

A task reads its part as a stream and closes a shard whenever ``shard_items`` turns and
conversations are held. In a shard the symbols become numbers in sorted order (its
dictionary), and the distinct paths enter a ternary search tree by median insertion: the
middle path first, then the middles of both halves. An iterative walk adds up members,
leaves and savings from the leaves upwards.

Only prefixes of a shard's first and last path can occur in other shards. Those
boundary nodes leave as one row for each of the two paths; one narrow pass in path order
merges them on a stack as deep as the longest conversation. All other nodes are
complete. Ids that end on boundary nodes travel as pieces of text keyed by node and are
hashed as a stream in order.

A null role or text is an empty one. Turns come by number, null first; turns of one number
by the digest of their role and text, so repeated rows are repeated turns. A row without
``conv_id`` belongs to no conversation and is left out. No conversations: no nodes.
Further columns of any name are not read. ``conv_id`` must be an integer type. A
conversation, 20 bytes a turn, must fit into a task; texts do not travel.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored

SYMBOL = 20
DIGEST = 16
SHARD_ITEMS = 400_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


def symbol(role: Column, text: Column) -> Column:
    """20 bytes for a turn; equal only for equal role and text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    size = F.octet_length(text)
    whole = F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text))
    return F.concat(
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, DIGEST), F.unhex(F.lpad(F.hex(size), 8, "0"))
    )


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path): one row per conversation of ``turns`` (conv_id, turn, role, text)."""
    own = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", symbol(F.col("role"), F.col("text")).alias("symbol")).alias("t"),
    )
    listed = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return listed.select("conv_id", joined(F.col("turns.symbol")).alias("path"))


def joined(symbols: Column) -> Column:
    """An array of symbols as one path."""
    return F.unhex(F.array_join(F.transform(symbols, F.hex), ""))


def rebuilt(rows: DataFrame, block: int = 5, longest: int = 9) -> DataFrame:
    """Paths as regenerated conversations: c opens with the first h turns of conversation
    c - c % block, then has its own after its first h; h is crc32(decimal c) % longest.

    Rows of a block meet by one shuffle; a block has at most ``block`` conversations.
    """
    from pyspark.sql import Window

    inside = Window.partitionBy("block")
    first = F.col("conv_id") - F.col("conv_id") % block
    known = rows.withColumn("block", first)
    opening = F.max(F.when(F.col("conv_id") == F.col("block"), F.col("path"))).over(inside)
    cut = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest * SYMBOL).cast("int")
    empty = F.lit(b"")
    return known.withColumn("opening", opening).select(
        "conv_id",
        F.concat(
            F.coalesce(F.substring(F.col("opening"), F.lit(1), cut), empty),
            F.coalesce(F.substring(F.col("path"), cut + 1, F.length("path")), empty),
        ).alias("path"),
    )


class TernaryTree:
    """A ternary search tree over integer strings; node 0 is the empty string."""

    def __init__(self) -> None:
        self.symbol, self.low, self.high, self.down, self.parent = [-1], [0], [0], [0], [-1]

    def _new(self, symbol: int, parent: int) -> int:
        for column, value in zip((self.symbol, self.low, self.high, self.down, self.parent), (symbol, 0, 0, 0, parent)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, string: list[int]) -> int:
        """The node of ``string``; missing ones are added."""
        at = 0
        for s in string:
            node = self.down[at]
            if not node:
                node = self.down[at] = self._new(s, at)
            while self.symbol[node] != s:
                side = self.low if s < self.symbol[node] else self.high
                if not side[node]:
                    side[node] = self._new(s, at)
                node = side[node]
            at = node
        return at

    def walk(self) -> list[int]:
        """All nodes, each after its parent, siblings by symbol."""
        order, todo = [0], [(self.down[0], False)]
        while todo:
            node, ready = todo.pop()
            if not node:
                continue
            if ready:
                order.append(node)
                todo.append((self.down[node], False))
            else:
                todo += [(self.high[node], False), (node, True), (self.low[node], False)]
        return order


def median_order(n: int) -> Iterator[int]:
    """0..n-1, the middle first, then the middles of both halves."""
    todo = [(0, n)]
    while todo:
        low, high = todo.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            todo += [(middle + 1, high), (low, middle)]


def _size(symbol_bytes: bytes) -> int:
    return int.from_bytes(symbol_bytes[DIGEST:], "big")


def _symbols(path: bytes) -> list[bytes]:
    return [path[i : i + SYMBOL] for i in range(0, len(path), SYMBOL)]


def node_key(parent: bytes, symbol_bytes: bytes) -> bytes:
    """The key of a node below the node of key ``parent``; the root's key is ``bytes(16)``."""
    return hashlib.blake2b(parent + symbol_bytes, digest_size=16).digest()


ROOT = bytes(16)
LONG, LONGS = pa.int64(), pa.list_(pa.int64())
SHARD_SCHEMA = (
    "what string, conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, part int, seq int, key binary, data binary,"
    " members array<long>, smallest array<long>, children array<long>, leaves array<long>, saved array<long>"
)
_FIELDS = [
    ("what", pa.string()), ("conv_id", LONG), ("depth", LONG), ("parent_conv_id", LONG), ("parent_key", pa.binary()),
    ("n_convs", LONG), ("n_children", LONG), ("n_leaves", LONG), ("saved_tokens", LONG), ("ends_sha256", pa.string()),
    ("part", pa.int32()), ("seq", pa.int32()), ("key", pa.binary()), ("data", pa.binary()),
    ("members", LONGS), ("smallest", LONGS), ("children", LONGS), ("leaves", LONGS), ("saved", LONGS),
]


def _ids_text(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def shard_rows(groups: list[tuple[bytes, list[int]]], part: int, seq: int) -> list[dict]:
    """Rows of one shard: complete nodes, two edges, and the ids ending on boundary nodes.

    ``groups`` holds the distinct paths in order, each with its ids in order.
    """
    split = [_symbols(p) for p, _ in groups]
    known = sorted({s for p in split for s in p})
    number = {s: i for i, s in enumerate(known)}
    sizes = [_size(s) for s in known]
    coded = [[number[s] for s in p] for p in split]
    tree, ends = TernaryTree(), {}
    for i in median_order(len(groups)):
        ends[tree.insert(coded[i])] = i

    n = len(tree.symbol)
    order = tree.walk()
    members, smallest = [0] * n, [None] * n
    children, leaves, saved, depth, edge = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for node, i in ends.items():
        members[node], smallest[node] = len(groups[i][1]), groups[i][1][0]
    for node in order[1:]:
        depth[node] = depth[tree.parent[node]] + 1
    chains = []
    for string in (coded[0], coded[-1]):
        chain = [0]
        for s in string:
            node = tree.down[chain[-1]]
            while tree.symbol[node] != s:
                node = tree.low[node] if s < tree.symbol[node] else tree.high[node]
            chain.append(node)
        chains.append(chain)
        for node in chain:
            edge[node] = True
    # from the leaves upwards; boundary nodes do not hand their leaves and savings on
    for node in reversed(order):
        up = tree.parent[node]
        if not edge[node]:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * sizes[tree.symbol[node]]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        if up >= 0:
            members[up] += members[node]
            if smallest[up] is None or smallest[node] < smallest[up]:
                smallest[up] = smallest[node]

    key: dict[int, bytes] = {0: ROOT}
    for chain in chains:
        for up, node in zip(chain, chain[1:]):
            key[node] = node_key(key[up], known[tree.symbol[node]])
    out = []
    for node in order:
        i = ends.get(node)
        if edge[node]:
            if i is not None:
                out.append({"what": "ends", "key": key[node], "conv_id": groups[i][1][0], "data": _ids_text(groups[i][1])})
            continue
        up = tree.parent[node]
        out.append(
            {
                "what": "node",
                "conv_id": smallest[node],
                "depth": depth[node],
                "parent_conv_id": None if edge[up] else smallest[up],
                "parent_key": key[up] if edge[up] else None,
                "n_convs": members[node],
                "n_children": children[node],
                "n_leaves": leaves[node],
                "saved_tokens": saved[node],
                "ends_sha256": NO_ENDS if i is None else hashlib.sha256(_ids_text(groups[i][1])).hexdigest(),
            }
        )
    told: set[int] = set()
    for side, chain in enumerate(chains):
        fresh = [node not in told for node in chain]
        told.update(chain)
        row = {"what": "edge", "part": part, "seq": 2 * seq + side, "data": groups[-side][0]}
        for name, column in (("members", members), ("children", children), ("leaves", leaves), ("saved", saved)):
            row[name] = [column[node] if new else 0 for node, new in zip(chain, fresh)]
        row["smallest"] = [smallest[node] for node in chain]
        out.append(row)
    return out


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([r.get(name) for r in rows], kind) for name, kind in _FIELDS], [name for name, _ in _FIELDS]
    )


def _shards(batches: Iterator[pa.RecordBatch], shard_items: int) -> Iterator[pa.RecordBatch]:
    """Sorted (path, conv_id) rows, cut into shards of about ``shard_items`` items."""
    part, seq = TaskContext.get().partitionId(), 0
    groups: list[tuple[bytes, list[int]]] = []
    held = 0
    for batch in batches:
        for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held >= shard_items:
                yield _batch(shard_rows(groups, part, seq))
                groups, held, seq = [], 0, seq + 1
            if not groups or groups[-1][0] != path:
                groups.append((path, []))
                held += len(path) // SYMBOL
            groups[-1][1].append(conv)
            held += 1
    if groups:
        yield _batch(shard_rows(groups, part, seq))


EDGE_COLUMNS = ["data", "members", "smallest", "children", "leaves", "saved"]
MERGED_SCHEMA = (
    "key binary, parent_key binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"
)


def merged_edges(rows: Iterator[tuple]) -> Iterator[dict]:
    """Boundary nodes of all shards from their edges in path order, children before parents."""
    stack: list[dict] = []
    path: list[bytes] = []

    def close() -> dict:
        node = stack.pop()
        if stack:
            path.pop()
            up = stack[-1]
        if not node["n_children"]:
            node["n_leaves"] = 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node.pop("size")
        if stack:
            up["n_children"] += 1
            up["n_leaves"] += node["n_leaves"]
            up["saved_tokens"] += node["saved_tokens"]
        return node

    for data, members, smallest, children, leaves, saved in rows:
        new = _symbols(data)
        same = 0
        while same < min(len(path), len(new)) and path[same] == new[same]:
            same += 1
        while len(stack) > same + 1:
            yield close()
        for d in range(len(new) + 1):
            if d == len(stack):
                up = stack[-1]["key"] if stack else None
                if d:
                    path.append(new[d - 1])
                stack.append(
                    {
                        "key": node_key(up, new[d - 1]) if d else ROOT,
                        "parent_key": up,
                        "conv_id": smallest[d],
                        "depth": d,
                        "n_convs": 0,
                        "n_children": 0,
                        "n_leaves": 0,
                        "saved_tokens": 0,
                        "size": _size(new[d - 1]) if d else 0,
                    }
                )
            node = stack[d]
            node["conv_id"] = min(node["conv_id"], smallest[d])
            node["n_convs"] += members[d]
            node["n_children"] += children[d]
            node["n_leaves"] += leaves[d]
            node["saved_tokens"] += saved[d]
    while stack:
        yield close()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in EDGE_COLUMNS))

    kinds = [pa.binary(), pa.binary(), *[LONG] * 6]
    names = ["key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    held: list[dict] = []

    def flush() -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[n] for r in held], k) for n, k in zip(names, kinds)], names)

    for node in merged_edges(rows()):
        held.append(node)
        if len(held) >= 10_000:
            yield flush()
            held = []
    if held:
        yield flush()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a node's ids, sorted by node and first id, as one digest for each node."""
    key, digest, keys, digests = None, None, [], []
    for batch in batches:
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    keys.append(key)
                    digests.append(digest.hexdigest())
                key, digest = k, hashlib.sha256(data)
            else:
                digest.update(b",")
                digest.update(data)
    if key is not None:
        keys.append(key)
        digests.append(digest.hexdigest())
    yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(rows: DataFrame, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per trie node from (conv_id, path): its smallest member, depth, parent's
    smallest member, members, children, leaves below, bytes saved by sharing, and the
    digest of the ids that end on it.
    """
    rows = stored(rows.select("path", "conv_id"), "paths")
    ordered = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    shards = stored(ordered.mapInArrow(functools.partial(_shards, shard_items=shard_items), SHARD_SCHEMA), "shards")
    # two rows a shard, read as a stream
    edges = shards.where("what = 'edge'").select("part", "seq", *EDGE_COLUMNS)
    merged = edges.repartition(1).sortWithinPartitions("part", "seq").select(*EDGE_COLUMNS).mapInArrow(_merged, MERGED_SCHEMA)
    pieces = shards.where("what = 'ends'").select("key", "data", "conv_id")
    ends = pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "data")
    boundary = stored(
        merged.join(ends.mapInArrow(_hashed, "key binary, ends_sha256 string"), "key", "left").withColumn(
            "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))
        ),
        "boundary",
    )
    parents = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nodes = shards.where("what = 'node'")
    below = nodes.where("parent_key IS NOT NULL").drop("parent_conv_id")
    return (
        nodes.where("parent_key IS NULL")
        .select(*COLUMNS)
        .unionByName(below.join(parents, "parent_key").select(*COLUMNS))
        .unionByName(boundary.join(parents, "parent_key", "left").select(*COLUMNS))
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations of ``turns`` (conv_id, turn, role, text) as they are."""
    return trie(paths(turns))
