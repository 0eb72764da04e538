"""Prefix tree of conversations: union-find over the common prefixes of sorted neighbours.

A sequence is a conversation's turns as fixed-width digests in a row, so a common prefix of turns is a common prefix of
bytes. Equal sequences are counted first. The different ones are sorted over all partitions; then the tree is in the
lengths of the prefixes that neighbours share. A task takes these edges in descending depth through a union-find: every
merge of two components creates a branching node at the edge's depth, or extends the one that is there.

Nodes on the way to a task's first or last sequence are open: they may go on in the neighbouring partitions. All others
are complete and leave at once. What remains of a partition, its forest contracted to the two ways, has no more nodes than
these two sequences have turns. Contracted forests are merged across their boundaries, ``FAN`` neighbours to a task and
round by round; each merge joins the prefix that two neighbours share and completes the nodes beside the new ways.
Children that leave before their open parent learn its id at the end, by partition and parent, so
the many children of one parent are spread over the partitions.

The ids of equal sequences go through one hash in numerical order. They travel as joined runs, and are hashed as they
stream by.

A turn's place among others of a conversation: null first, equal ones by their digests. Null role or text: empty. Rows without a
conversation id belong to none. A conversation is one row of 16 bytes for each turn, whatever the length of its texts; that row has to
fit into a task. An empty table gives no rows, not even a root. Repeated rows are turns each. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm import common
from wayfare.llm.common import saved

#: Bytes of a turn's digest; contracted forests merged by one task of a round.
DIGEST, FAN = 16, 16
#: Bytes of sequences that one union-find works on.
BLOCK_BYTES = 1 << 22
NONE_END = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, key binary, parent_key binary, part long, forest binary"
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest_of(path: bytes, depth: int) -> bytes:
    return hashlib.md5(path[: depth * DIGEST]).digest()


def common_depth(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // DIGEST


@dataclass
class Open:
    """A node that may have more members, with what its complete children add up to."""

    n: int
    low: int
    words: int
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str = NONE_END

    def take(self, leaves: int, saved: int) -> None:
        self.children += 1
        self.leaves += leaves
        self.saved += saved


@dataclass
class Forest:
    """The open nodes by depth on the way to the first sequence, and to the last one; up to ``trunk`` they are the same."""

    first: bytes
    last: bytes
    left: list[Open]
    right: list[Open]
    trunk: int


@dataclass
class Nodes:
    """Complete nodes, column by column."""

    part: int
    columns: list[list] = field(default_factory=lambda: [[] for _ in range(10)])

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    def batches(self, forest: Forest | None) -> Iterator[pa.RecordBatch]:
        n = len(self.columns[0])
        columns = [*self.columns, [self.part] * n, [None] * n]
        if forest:
            for column in columns[:10]:
                column.append(None)
            columns[10].append(self.part)
            columns[11].append(pickle.dumps(forest))
        kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in NODE.split(", ")])


def _complete(way: list[Open], path: bytes, deepest: int, above: int, parent: Open, nodes: Nodes) -> None:
    """The nodes of a way from ``deepest`` up to the one below depth ``above``, whose parent stays open."""
    for depth in range(deepest, above, -1):
        node, top = way[depth], depth - 1 == above
        over = parent if top else way[depth - 1]
        leaves = node.leaves if node.children else 1
        saved_tokens = node.saved + (node.n - 1) * node.words
        over.take(leaves, saved_tokens)
        parent_key = digest_of(path, above) if top else None
        row = (node.low, depth, None if top else over.low, node.n, node.children, leaves, saved_tokens, node.ends)
        nodes.add(*row, digest_of(path, depth), parent_key)


def merged(a: Forest, b: Forest, nodes: Nodes) -> Forest:
    """The forest of two neighbours; nodes that lie on neither outer way are complete."""
    if not a.last < b.first:
        raise ValueError("forests are not in the order of their sequences")
    shared = common_depth(a.last, b.first)
    for depth in range(shared + 1):
        u, v = a.right[depth], b.left[depth]
        u.n, u.low = u.n + v.n, min(u.low, v.low)
        u.children, u.leaves, u.saved = u.children + v.children, u.leaves + v.leaves, u.saved + v.saved
        u.ends = v.ends if u.ends == NONE_END else u.ends
        if depth <= b.trunk:
            b.right[depth] = u
    above = max(shared, b.trunk)
    _complete(b.left, b.first, len(b.left) - 1, above, b.left[above] if above > shared else a.right[shared], nodes)
    above = max(a.trunk, min(shared, b.trunk))
    _complete(a.right, a.last, len(a.right) - 1, above, a.right[above], nodes)
    return Forest(a.first, b.last, a.left, b.right, min(a.trunk, shared, b.trunk))


def finished(forest: Forest, nodes: Nodes) -> None:
    """All nodes of the last forest are complete."""
    trunk = forest.trunk
    for way, path in ((forest.left, forest.first), (forest.right, forest.last)):
        _complete(way, path, len(way) - 1, trunk, way[trunk], nodes)
    _complete(forest.left, forest.first, trunk, 0, forest.left[0], nodes)
    root = forest.left[0]
    row = (root.low, 0, None, root.n, root.children, root.leaves if root.children else 1, root.saved, root.ends)
    nodes.add(*row, digest_of(b"", 0), None)


class Component:
    """A branching node, or the end of a sequence, in a block's tree."""

    __slots__ = ("depth", "n", "low", "rep", "ends", "children", "above", "first", "last")

    def __init__(self, depth: int, n: int, low: int, rep: int, ends: str, children: list[Component]):
        self.depth, self.n, self.low, self.rep, self.ends, self.children = depth, n, low, rep, ends, children
        self.above, self.first, self.last = None, False, False

    def absorb(self, other: Component) -> None:
        """The other component lies below this node, or is the same node."""
        self.n, self.low = self.n + other.n, min(self.low, other.low)
        if other.depth > self.depth:
            self.children.append(other)
        else:
            self.children += other.children
            self.ends = other.ends if self.ends == NONE_END else self.ends


def _tree(rows: list[tuple], shared: list[int]) -> Component:
    """The top of a block's tree; rows are (path, words, n, id, ends)."""
    top = [Component(len(r[0]) // DIGEST, r[2], r[3], k, r[4], []) for k, r in enumerate(rows)]
    parent = list(range(len(rows)))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k in sorted(range(len(shared)), key=lambda k: -shared[k]):
        i, j, depth = find(k), find(k + 1), shared[k]
        x, y = sorted((top[i], top[j]), key=lambda c: c.depth)
        if x.depth > depth:
            x = Component(depth, x.n, x.low, x.rep, NONE_END, [x])
        x.absorb(y)
        parent[j], top[i] = i, x
    return top[find(0)]


def block_forest(rows: list[tuple], nodes: Nodes) -> Forest:
    """The contracted forest of sorted sequences; nodes off the ways to the first and the last one are complete."""
    shared = [common_depth(a[0], b[0]) for a, b in zip(rows, rows[1:], strict=False)]
    top = _tree(rows, shared)
    order, walk = [], [top]
    while walk:
        c = walk.pop()
        order.append(c)
        for child in c.children:
            child.above = c
        walk += c.children
    first, last = rows[0][0], rows[-1][0]
    ways: list[dict[int, Open]] = [{}, {}]
    sums: dict[int, list[int]] = {id(c): [0, 0, 0] for c in order}  # complete children, their leaves and saved tokens
    for c in order:  # from the top
        path = rows[c.rep][0]
        c.first = (c.above is None or c.above.first) and common_depth(path, first) >= c.depth
        c.last = (c.above is None or c.above.last) and common_depth(path, last) >= c.depth
    for c in reversed(order):  # children before their parents
        path, words, above = rows[c.rep][0], rows[c.rep][1], c.above.depth if c.above else -1
        children, leaves_below, saved_below = sums[id(c)]
        if c.first or c.last:
            for depth in range(c.depth, above, -1):
                node = Open(c.n, c.low, int(words[depth - 1]) if depth else 0)
                if depth == c.depth:
                    node.children, node.leaves, node.saved, node.ends = children, leaves_below, saved_below, c.ends
                for way, on in zip(ways, (c.first, c.last), strict=True):
                    if on:
                        way[depth] = node
            continue
        leaves_below = leaves_below if children else 1
        for depth in range(c.depth, above, -1):
            saved_below += (c.n - 1) * int(words[depth - 1])
            bottom, highest = depth == c.depth, depth == above + 1
            over = c.above if highest else c
            waits = over.first or over.last
            row = (c.low, depth, None if waits else over.low, c.n, children if bottom else 1, leaves_below, saved_below)
            nodes.add(*row, c.ends if bottom else NONE_END, None, digest_of(path, depth - 1) if waits else None)
        own = sums[id(c.above)]
        own[0], own[1], own[2] = own[0] + 1, own[1] + leaves_below, own[2] + saved_below
    left, right = ([way[d] for d in range(len(way))] for way in ways)
    return Forest(first, last, left, right, min(shared, default=len(first) // DIGEST))


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, forest = TaskContext.get().partitionId(), None
    for portion in common.portions(batches, BLOCK_BYTES):
        nodes = Nodes(part)
        rows = list(zip(*(portion[c].to_pylist() for c in ("path", "words", "n", "conv_id", "ends_sha256")), strict=True))
        block = block_forest(rows, nodes)
        forest = merged(forest, block, nodes) if forest else block
        yield from nodes.batches(None)
    if forest:
        yield from Nodes(part).batches(forest)


def _joined(fan: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    """The forests of a group of ``fan`` neighbours in one; the last round completes it."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        first, forest = table["part"][0].as_py(), None
        nodes = Nodes(first // fan)
        for raw in table["forest"].to_pylist():
            other = pickle.loads(raw)
            forest = merged(forest, other, nodes) if forest else other
        if last:
            finished(forest, nodes)
            forest = None
        return pa.Table.from_batches(list(nodes.batches(forest)))

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids with the same key, one after another, as one text."""
    for batch in batches:
        keys, ids = batch["key"].to_pylist(), batch["conv_id"].to_pylist()
        starts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
        texts = [",".join(map(str, ids[a:b])) for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
        columns = [pa.array([keys[a] for a in starts], pa.binary()), pa.array([ids[a] for a in starts], pa.int64()), pa.array(texts)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each key's texts, joined by commas, as they stream by."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, text in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if k != key or state is None:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield _digests(done)
    if state is not None:
        yield _digests([(key, state.hexdigest())])


def _digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["key", "ends_sha256"])


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: array of (turn, digest of role and text, words of the text)."""
    role, text = (f"coalesce(CAST({c} AS STRING), '')" for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").selectExpr(
        "CAST(conv_id AS LONG) AS conv_id",
        "turn",
        f"md5(CAST(concat(length({role}), ':', {role}, {text}) AS BINARY)) AS digest",
        f"CAST(regexp_count({text}, '[^\\\\x20\\\\x09-\\\\x0D]+') AS INT) AS words",
    )
    # the conversations of one twenty lie together from the start, so sharing their first turns needs no shuffle
    turns = turns.withColumn("base", F.expr("conv_id - conv_id % 20")).repartition("base")
    return turns.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("turns"))


def with_shared_starts(sequences: DataFrame) -> DataFrame:
    """Every conversation c rebuilt: the first crc32(c) % 4 turns of conversation c - c % 20, then its own after as many."""
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 3))).over(Window.partitionBy("base"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    rebuilt = sequences.withColumn("head", head).withColumn("h", shared.cast("int"))
    none = "filter(turns, t -> false)"
    return rebuilt.selectExpr(
        "conv_id",
        f"concat(slice(coalesce(head, {none}), 1, h), slice(turns, h + 1, size(turns))) AS turns",
    )


def prefix_tree(sequences: DataFrame, fan: int = FAN) -> DataFrame:
    """The nodes of the tree over conv_id and turns (an array of structs with digest and words)."""
    spark = sequences.sparkSession
    common.prepared(spark)
    sequences = sequences.selectExpr(
        "conv_id", "unhex(array_join(transform(turns, t -> t.digest), '')) AS path", "transform(turns, t -> t.words) AS words"
    )
    sequences = saved(sequences.withColumn("key", F.unhex(F.md5("path"))), "sequences")
    ids = sequences.select("key", "conv_id").repartitionByRange("conv_id").sortWithinPartitions("key", "conv_id")
    runs = ids.mapInArrow(_runs, "key binary, first long, ids string").repartition("key").sortWithinPartitions("key", "first")
    ends = runs.mapInArrow(_hashed, "key binary, ends_sha256 string")
    different = sequences.groupBy("key").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("path").alias("path"), F.first("words").alias("words")
    )
    different = saved(different.join(ends, "key").drop("key"), "different")
    ordered = different.repartitionByRange("path").sortWithinPartitions("path")
    nodes = built = saved(ordered.mapInArrow(_built, NODE), "nodes")
    while True:
        forests = built.filter("forest IS NOT NULL").select("part", "forest")
        parts = forests.agg(F.max("part")).first()[0]
        if parts is None:
            break
        group = F.expr(f"part DIV {fan}").alias("g")
        built = saved(forests.groupBy(group).applyInArrow(_joined(fan, parts < fan), NODE), "nodes")
        nodes = nodes.union(built)
        if parts < fan:
            break
    nodes = nodes.filter("forest IS NULL")
    waiting = nodes.filter("parent_key IS NOT NULL").drop("parent_conv_id")
    opened = nodes.filter("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    parents = waiting.select("part", "parent_key").distinct().join(opened, "parent_key")
    return nodes.filter("parent_key IS NULL").select(COLUMNS).union(waiting.join(parents, ["part", "parent_key"]).select(COLUMNS))
