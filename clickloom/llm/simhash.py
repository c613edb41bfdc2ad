"""Near-duplicate documents by SimHash: fingerprints, pigeonhole blocks, verified bit distance.

Two 64-bit fingerprints at most `distance` bits apart differ in at most that many of `blocks`
blocks, so they agree on some choice of `blocks - distance` of them. Each choice is a table:
fingerprints that agree on it meet in one bucket and their distance is checked there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import saved
from clickloom.llm.components import components

SHINGLE, DISTANCE, BLOCKS = 4, 4, 6
BUCKET = 4096  # distinct fingerprints of a bucket that one group compares; larger buckets are cut into pairs of chunks
FEW = 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles (repeats included), as an unsigned 64-bit number.

    Fewer words than a shingle count as one shingle; null or wordless texts give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z, splits at 09-0D and 20
    if not words:
        return 0
    size, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    joined = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    count = len(words) - size + 1
    hashes = np.fromiter((digest(s, 42) for s in joined), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, 65536):
        part = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`id, fp` (signed long) for every row."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(id_column).alias("id"), fp(F.col(text_column)).alias("fp"))


def _masks(distance: int, blocks: int) -> list[int]:
    """A mask for each choice of `blocks - distance` blocks, as signed longs."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    bits = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [int(np.uint64(sum(c)).astype(np.int64)) for c in combinations(bits, blocks - distance)]


def _forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within the distance: each found value looks only at those not found yet."""
    rest, left, right = np.unique(values), [], []
    while rest.size:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and rest.size:
            near = np.bitwise_count(rest ^ frontier[-1]) <= distance
            at = frontier.pop()
            if near.any():
                found, rest = rest[near], rest[~near]
                left.append(np.full(found.size, at))
                right.append(found)
                frontier.extend(found)
    empty = [np.empty(0, values.dtype)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def _bucket_links(distance: int):
    """Links inside the buckets of a sorted stream; a bucket cut by a batch waits for the next one."""

    def link(group: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[starts, group.size])
        few = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
        small, value = group[few], fp[few]
        left, right = [], []
        for step in range(1, min(FEW, value.size)):
            hit = (small[step:] == small[:-step]) & (np.bitwise_count(value[step:] ^ value[:-step]) <= distance)
            left.append(value[:-step][hit])
            right.append(value[step:][hit])
        for i in np.flatnonzero(sizes > FEW):
            a, b = _forest(fp[starts[i] : starts[i] + sizes[i]], distance)
            left.append(a)
            right.append(b)
        empty = [np.empty(0, fp.dtype)]
        ends = (np.concatenate(x or empty).view(np.int64) for x in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty((0, 3), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            new = np.column_stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("t", "key", "part")])
            keys = np.concatenate([keys, new])
            fps = np.concatenate([fps, np.asarray(batch.column("fp")).view(np.uint64)])
            if not fps.size:
                continue
            group = np.r_[0, np.cumsum((keys[1:] != keys[:-1]).any(axis=1))]
            whole = int(np.searchsorted(group, group[-1]))
            if whole:
                yield link(group[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
        if fps.size:
            yield link(np.zeros(fps.size, np.int64), fps)

    return run


def links(values: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """`a, b`: links that connect all distinct `fp` values at most `distance` bits apart.

    Inside a bucket only a spanning forest is emitted. A bucket of more than `bucket` values is
    cut into chunks and every pair of chunks is a group of its own, so no link is lost.
    """
    masks = [F.col("fp").bitwiseAND(F.lit(m)) for m in _masks(distance, blocks)]
    keyed = values.select("fp", F.posexplode(F.array(*masks)).alias("t", "key"))
    large = keyed.groupBy("t", "key").count().filter(F.col("count") > bucket)
    large = large.select("t", "key", F.ceil(F.col("count") / bucket).alias("chunks"))
    keyed = keyed.join(large, ["t", "key"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    parts = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda other: F.least(own, other) * F.col("chunks") + F.greatest(own, other),
    )
    cut = keyed.select("t", "key", "fp", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(parts)).alias("part"))
    cut = cut.repartition("t", "key", "part").sortWithinPartitions("t", "key", "part")
    return cut.mapInArrow(_bucket_links(distance), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """`id, fp, component`: the component is the least id reachable over links of at most `distance` bits.

    One row per input row, so repeated rows stay repeated. Null, empty and wordless texts have
    fingerprint 0 and link like any other. Null ids are never a component's name; a component
    without any id has a null name. An empty table gives no rows; other columns are ignored.
    """
    rows = saved(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    found = components(links(nodes.select("fp"), distance, blocks))
    linked = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    linked = saved(linked, "linked")
    names = linked.groupBy("root").agg(F.min("first").alias("component"))
    return rows.join(linked.join(names, "root").select("fp", "component"), "fp").select("id", "fp", "component")
