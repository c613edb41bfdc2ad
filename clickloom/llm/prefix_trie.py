"""A trie of conversation prefixes with subtree totals, by time-forward processing.

Conversations are range-sorted by their path, the digests of their turns end to end, so the members of
every node lie side by side and a partition is a shard: a run of conversations that one pass with a
stack turns into nodes. Only nodes on a shard's first or last path can have members elsewhere.

Within a shard Spark sorts the nodes by reverse level order (an external sort), and totals travel
forward to parents through a priority queue that spills. Nodes on the edge of a shard keep what reached
them; their shares are summed by node, and the same pass over these shard roots, at most two paths
for each shard, gives the totals across shards.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import saved

FAMILY, HEAD = 5, 8  # conversations that share a start, and the longest start they share
QUEUE = 200_000  # messages that a queue holds in memory before it spills
BLOCK = 4096  # conversation ids of one block of a digest
DIGEST = 16
ROWS = 16_384

_SHARD = "depth int, key binary, parent binary, conv_id long, n_convs long, bytes long, edge boolean"
_TOTALS = "depth int, key binary, parent binary, conv_id long, n_convs long, bytes long, edge boolean, n_children long, n_leaves long, saved_tokens long"


class SpillingQueue:
    """A priority queue of tuples; beyond `limit` its content goes, sorted, to an unnamed file of this task."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            # Private to the task like Spark's own spills, in the folder Spark gives them, and gone when closed.
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
            run = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
            for item in sorted(self.heap):
                pickle.dump(item, run)
            run.seek(0)
            self.heap.clear()
            self._next(run)

    def _next(self, run) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(run), id(run), run))
        except EOFError:
            run.close()

    def pop_all(self, target: tuple) -> Iterator[tuple]:
        """The messages that start with `target`, which is not behind any message in the queue."""
        size = len(target)
        while self.heap and self.heap[0][:size] == target:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:size] == target:
            item, _, run = heapq.heappop(self.runs)
            self._next(run)
            yield item


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


_ARROW = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def shard_nodes(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes of a shard from its conversations `path, sizes, conv_id` in order of path."""
    stack: list[list] = []  # depth, key, parent, least conversation, conversations, bytes, on the edge
    before, first = None, True

    def key(state) -> bytes:
        return state.digest()[:DIGEST]

    for path, sizes, conv in rows:
        depth = len(path) // DIGEST
        if before is None:
            states = [hashlib.sha256()]
            stack.append([0, key(states[0]), None, conv, 0, 0, True])
            shared = 0
        else:
            shared = len(os.path.commonprefix([before, path])) // DIGEST
        while len(stack) > shared + 1:
            yield tuple(stack.pop())
            states.pop()
        for d in range(shared + 1, depth + 1):
            state = states[-1].copy()
            state.update(path[DIGEST * (d - 1) : DIGEST * d])
            states.append(state)
            stack.append([d, key(state), stack[-1][1], conv, 0, sizes[d - 1], first])
        for node in stack:
            node[3] = min(node[3], conv)
            node[4] += 1
        before, first = path, False
    while stack:
        node = stack.pop()
        node[6] = True
        yield tuple(node)


def time_forward(rows: Iterator[tuple], limit: int = QUEUE) -> Iterator[tuple]:
    """Nodes in reverse level order, with the totals that their descendants send.

    A row is `depth, key, parent, conv_id, n_convs, bytes, edge` and what it knows already of `n_children,
    n_leaves, saved_tokens`. A node on the edge gets what reached it and sends nothing on.
    """
    queue = SpillingQueue(limit)
    for depth, key, parent, conv, convs, size, edge, *known in rows:
        children, leaves, spared = known or (0, 0, 0)
        for _, _, n, l, s in queue.pop_all((-depth, key)):
            children, leaves, spared = children + n, leaves + l, spared + s
        if not edge:
            leaves = leaves or 1
            spared += (convs - 1) * size
            if depth:
                queue.push((1 - depth, parent, 1, leaves, spared))
        yield depth, key, parent, conv, convs, size, edge, children, leaves, spared


def _digest(role: Column, text: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)


def rebuilt(turns: DataFrame, family: int = FAMILY, head: int = HEAD) -> DataFrame:
    """`conv_id, path, sizes` of every conversation after it took its first turns from the family's first one.

    Conversation c takes the first h turns of conversation c - c % family, h = crc32(c) % (head + 1), and
    goes on with its own turns after its first h. A conversation is one row of 20 bytes a turn; texts stay out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    turn = F.struct(place.alias("place"), _digest(F.col("role"), F.col("text")).alias("digest"), F.octet_length("text").alias("bytes"))
    own = rows.select("conv_id", turn.alias("one")).groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("own"))
    own = saved(own, "turns")
    heads = own.select(F.col("conv_id").alias("base"), F.slice("own", 1, head).alias("head"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(head + 1)).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn("taken", taken).join(heads, "base", "left")
    none = F.slice("own", 1, 0)
    start = F.slice(F.coalesce("head", none), F.lit(1), F.col("taken"))
    rest = F.slice("own", F.col("taken") + 1, F.greatest(F.size("own"), F.lit(1)))
    both = both.select("conv_id", F.concat(start, rest).alias("whole"))
    return both.select("conv_id", F.unhex(F.array_join("whole.digest", "")).alias("path"), F.col("whole.bytes").alias("sizes"))


def ends(convs: DataFrame) -> DataFrame:
    """`key, ends_sha256`: of each node where conversations end, their ids in order as one digest.

    Ids meet in blocks of at most `BLOCK`; a node's blocks are read one after the other, never held together.
    """
    key = F.unhex(F.substring(F.sha2("path", 256), 1, 2 * DIGEST))
    blocks = convs.groupBy(key.alias("key"), F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.select("key", "block", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for node, own in groupby(_rows(batches), lambda row: row[0]):
                state = hashlib.sha256(next(own)[2].encode())
                for _, _, ids in own:
                    state.update(b"," + ids.encode())
                yield node, state.hexdigest()

        yield from _batches(found(), pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())]))

    return blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(digests, "key binary, ends_sha256 string")


def trie(convs: DataFrame) -> DataFrame:
    """`key, conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens`, a row for each distinct prefix of the paths."""
    order = [F.desc("depth"), F.asc("key")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(shard_nodes(_rows(batches)), _arrow(_SHARD))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(time_forward(_rows(batches)), _arrow(_TOTALS))

    shards = convs.select("path", "sizes", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = saved(shards.mapInArrow(build, _SHARD).sortWithinPartitions(*order).mapInArrow(forward, _TOTALS), "nodes")
    sums = [F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    roots = nodes.filter("edge").groupBy("depth", "key").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("bytes").alias("bytes"), F.lit(False).alias("edge"), *sums
    )
    # One task, as the last step is sequential: its rows are two paths for each shard at most, whatever the shards hold.
    across = roots.repartition(1).sortWithinPartitions(*order).mapInArrow(forward, _TOTALS)
    return nodes.filter("not edge").unionByName(across).select("key", "conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens")


def prefix_trie(turns: DataFrame, family: int = FAMILY, head: int = HEAD) -> DataFrame:
    """`key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256` per node.

    Turns `conv_id, turn, role, text` are ordered by turn (null first), role and text; null roles and
    texts are empty, repeated rows are turns of their own, rows without a conversation and other columns
    are ignored. The root has no turns, depth 0 and no parent. An empty table gives no rows.
    """
    convs = saved(rebuilt(turns, family, head), "rebuilt")
    nodes = saved(trie(convs), "trie")
    parents = nodes.filter("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256().hexdigest()
    found = nodes.join(parents, "parent", "left").join(ends(convs), "key", "left")
    return found.select(
        "key", "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
