"""Near-duplicate vectors by a forest of random-projection trees with spill.

Each tree splits the space again and again at a random direction; a vector within a margin of a
split goes to both sides. Vectors that share a leaf in any tree are compared in double precision.
Only the forest (directions and thresholds) is fitted on a bounded sample; every vector is placed.

A node about as narrow as a linked pair is wide is not split any more: a cut would part many of its
links, and spill would copy most of it. It is compared whole, by pairs of chunks. Trees are added
until linked pairs of the sample, and partners made at the least cosine, meet as often as `RECALL`.

Equal vectors are one class and are compared once. A pair that shares several leaves is counted in
the first of them only, so a leaf emits counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import saved
from clickloom.llm.components import components

COSINE = 0.95
TREES, LEAF, MARGIN = 6, 256, 0.12  # leaf: vectors aimed at; margin: of the spread of a projection
SAMPLE = 8192  # vectors that thresholds are fitted on
LENGTH_BITS = 44  # of a leaf's number that lie below the number of its length
GROUP = 2048  # vectors compared in one group; larger leaves are cut into pairs of chunks
FITTED, LEAST = 12, 16  # levels with a threshold for each node, and sampled vectors that such a threshold takes
MOST = 1024  # trees that a forest may need before it is given up with an error
RECALL, PROBES = 0.995, 2048  # share of probe pairs that must meet in some tree; pairs of each kind
SEED = 7


class Forest:
    """Trees of one depth. Below the levels that the sample can speak for, a split is at the threshold above it."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES, margin: float = MARGIN, cosine: float = COSINE):
        self.depth, self.trees, self.margin, self.width = depth, 0, margin, sample.shape[1]
        self.narrow = math.sqrt(2 * max(0.0, 1 - cosine)) / math.sqrt(max(1, self.width))  # spread of a projected difference at that cosine
        self.random = np.random.default_rng(SEED)
        # One direction for each tree and level; a threshold for each node of the first levels, and whether it stays whole.
        self.directions, self.thresholds, self.spreads, self.whole = [], [], [], []
        for _ in range(trees):
            self._grow(sample)
        probes = [(a, b, np.zeros(len(a), bool)) for a, b in _probes(sample, cosine) if len(a)] if depth else []
        seen = 0
        while self.trees <= MOST:
            for a, b, met in probes:
                for tree in range(seen, self.trees):
                    met |= self._meet(tree, a, b)
            if all(met.mean() >= RECALL for _, _, met in probes):
                break
            seen = self.trees
            self._grow(sample)
        else:
            raise RuntimeError(f"linked pairs of the sample still miss each other in {MOST} trees")
        del self.random

    def _grow(self, sample: np.ndarray) -> None:
        self.directions.append(self.random.standard_normal((self.depth, self.width)) / math.sqrt(self.width))
        self.trees += 1
        at, thresholds, spreads, wholes = np.zeros(len(sample), np.int64), [], [], []
        whole = np.zeros(1, bool)
        for level in range(self.depth):
            values = sample @ self.directions[-1][level]
            middle = float(np.median(values)) if len(values) else 0.0
            spreads.append(float(values.std()) if len(values) else 0.0)
            cuts = np.full(1 << level if level < FITTED else 1, middle)
            if level < FITTED:
                whole = np.repeat(whole, 2) if level else whole
                order = np.argsort(at, kind="stable")
                nodes, starts, counts = np.unique(at[order], return_index=True, return_counts=True)
                for node, start, count in zip(nodes, starts, counts, strict=True):
                    if count >= LEAST:
                        own = values[order[start : start + count]]
                        cuts[node] = np.median(own)
                        whole[node] |= self._spread(sample[order[start : start + count]]) <= self.narrow
            thresholds.append(cuts)
            wholes.append(whole.copy())
            up = at >> max(0, level - FITTED + 1)
            at = 2 * at + ((values > cuts[at if len(cuts) > 1 else 0]) & ~whole[up])
        self.thresholds.append(thresholds)
        self.spreads.append(spreads)
        self.whole.append(wholes)

    def _spread(self, vectors: np.ndarray) -> float:
        """Spread of a projection, over all directions."""
        return math.sqrt(vectors.var(axis=0).sum() / self.width)

    def _place(self, tree: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, at = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        for level in range(self.depth):
            values = (vectors @ self.directions[tree][level])[row]
            cuts = self.thresholds[tree][level]
            off = values - (cuts[at] if len(cuts) > 1 else cuts[0])
            split = ~self.whole[tree][level][at >> max(0, level - FITTED + 1)]
            both = (np.abs(off) <= self.margin * self.spreads[tree][level]) & split
            at = 2 * at + ((off > 0) & split)
            row, at = np.concatenate([row, row[both]]), np.concatenate([at, at[both] ^ 1])
        return row, at

    def _meet(self, tree: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of rows, whether a leaf of this tree has both."""
        (i, x), (j, y) = self._place(tree, a), self._place(tree, b)
        met = np.zeros(len(a), bool)
        met[np.intersect1d((i << self.depth) + x, (j << self.depth) + y) >> self.depth] = True
        return met

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`row, leaf` for every leaf of every vector; leaves are numbered over all trees."""
        placed = [self._place(tree, vectors) for tree in range(self.trees)]
        return np.concatenate([row for row, _ in placed]), np.concatenate([at + (tree << self.depth) for tree, (_, at) in enumerate(placed)])


def _probes(sample: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of the sample, and sampled vectors with a partner made at the least cosine."""
    random = np.random.default_rng(SEED + 1)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, len(sample), 512):
        i, j = np.nonzero(sample[start : start + 512] @ sample.T >= cosine)
        i = i + start
        i, j = i[i < j], j[i < j]
        some = random.permutation(len(i))[:PROBES]  # each block has its say, whatever its number of links
        left.append(i[some])
        right.append(j[some])
    left, right = np.concatenate(left), np.concatenate(right)
    some = random.permutation(len(left))[:PROBES]
    own = sample[random.permutation(len(sample))[:PROBES]]
    away = random.standard_normal(own.shape)
    away -= (away * own).sum(axis=1, keepdims=True) * own
    length = np.linalg.norm(away, axis=1, keepdims=True)
    far = length[:, 0] > 1e-6  # vectors of one component have no such partner
    own, away = own[far], away[far] / length[far]
    made = cosine * own + math.sqrt(max(0.0, 1 - cosine**2)) * away
    return [(sample[left[some]], sample[right[some]]), (own, made)]


def _unit(vectors: list) -> np.ndarray:
    """Rows of length one, scaled first so that no square overflows."""
    full = np.array([np.asarray(v, np.float64) for v in vectors])
    full = full / np.abs(full).max(axis=1, keepdims=True)
    return full / np.linalg.norm(full, axis=1, keepdims=True)


def _compare(cosine: float):
    """Counts and a spanning forest of the links of one group: `a, b, links`, b null for a count."""

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        leaf, part = int(group["leaf"].iloc[0]), int(group["part"].iloc[0])
        unit = _unit(group["embedding"].tolist())
        link = unit @ unit.T >= cosine
        np.fill_diagonal(link, False)
        chunks, own = int(group["chunks"].iloc[0]), group["own"].to_numpy()
        if part // chunks != part % chunks:  # two chunks: each has its own pairs compared elsewhere
            link &= own[:, None] != own[None, :]
        # Pairs that also share an earlier leaf are counted there.
        before = [[x for x in leaves if x < leaf] for leaves in group["leaves"]]
        shared = Counter(x for xs in before for x in xs)
        number = {x: i for i, x in enumerate(sorted(x for x, n in shared.items() if n > 1))}
        if number and link.any():
            seen = np.zeros((len(group), len(number)), np.float32)
            for i, xs in enumerate(before):
                seen[i, [number[x] for x in xs if x in number]] = 1
            link &= seen @ seen.T == 0
        name, copies = group["c"].to_numpy(), group["copies"].to_numpy(np.int64)
        links = link @ copies
        some = links > 0
        counts = pd.DataFrame({"a": name[some], "b": pd.array([None] * int(some.sum()), "Int64"), "links": links[some]})
        left, right, fresh = [], [], np.ones(len(group), bool)
        for i in np.flatnonzero(some):
            frontier = [i] if fresh[i] else []
            fresh[i] = False
            while frontier:
                at = frontier.pop()
                found = np.flatnonzero(link[at] & fresh)
                fresh[found] = False
                frontier.extend(found)
                left.extend([name[at]] * len(found))
                right.extend(name[found])
        edges = pd.DataFrame({"a": np.array(left, np.int64), "b": pd.array(right, "Int64"), "links": np.zeros(len(left), np.int64)})
        return pd.concat([counts, edges])

    return compare


def _forests(classes: DataFrame, counts: dict[int, int], sample: int, trees: int, cosine: float) -> dict[int, Forest]:
    """A forest for each length of vectors, fitted on up to `sample` of them; few vectors of a length are one leaf."""
    depths = {length: max(0, math.ceil(math.log2(n / LEAF))) for length, n in counts.items()}
    drawn: dict[int, list] = {length: [] for length in counts}
    shares = [F.lit(x) for length, n in counts.items() if depths[length] for x in (length, int(min(1.0, 0.95 * sample / n) * 1_000_000))]
    if shares:
        share = F.coalesce(F.try_element_at(F.create_map(*shares), F.size("embedding")), F.lit(0))
        for row in classes.filter(F.pmod(F.xxhash64("embedding"), F.lit(1_000_000)) < share).select("embedding").toPandas()["embedding"]:
            drawn[len(row)].append(row)
    return {
        length: Forest(_unit(drawn[length]) if drawn[length] else np.zeros((0, length)), depths[length], trees if depths[length] else 1, cosine=cosine)
        for length in counts
    }


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, trees: int = TREES, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """`id, n_links, component` for every row: other rows linked directly, and the least id reachable by links.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    vectors link with those of their own length only; each length has a forest. Repeated rows and equal vectors link with each other; null ids count as links but
    never name a component. An empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("fine", F.coalesce(F.size("embedding") > 0, F.lit(False)) & F.coalesce(fine, F.lit(False)))
    classes = rows.filter("fine").groupBy("embedding").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    classes = saved(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    width = F.size("embedding")
    counts = {row.width: row["count"] for row in classes.groupBy(width.alias("width")).count().collect()}  # a row for each length there is
    forests = _forests(classes, counts, sample, trees, cosine)
    sent = vectors.sparkSession.sparkContext.broadcast(forests)  # a few thousand numbers for each tree

    @F.pandas_udf("array<long>")
    def leaves(batch: pd.Series) -> pd.Series:
        out, lengths = np.empty(len(batch), object), batch.map(len).to_numpy()
        for number, length in enumerate(sorted(sent.value)):
            which = np.flatnonzero(lengths == length)
            if which.size:
                row, leaf = sent.value[length].leaves(_unit(batch.iloc[which].tolist()))
                order = np.lexsort((leaf, row))
                parts = np.split(leaf[order] + (number << LENGTH_BITS), np.cumsum(np.bincount(row, minlength=which.size))[:-1])
                for at, part in zip(which, parts, strict=True):
                    out[at] = part
        return pd.Series(out)

    placed = saved(classes.select("c", "copies", "embedding", leaves("embedding").alias("leaves")), "placed")
    spread = placed.select("*", F.explode("leaves").alias("leaf"))
    sizes = spread.groupBy("leaf").agg(F.ceil(F.count("*") / GROUP).alias("chunks")).filter("chunks > 1")
    spread = spread.join(sizes, "leaf", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long")))
    spread = spread.withColumn("own", F.pmod(F.xxhash64("c"), F.col("chunks")))
    parts = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda other: F.least(F.col("own"), other) * F.col("chunks") + F.greatest(F.col("own"), other),
    )
    spread = spread.withColumn("part", F.explode(parts))
    found = saved(spread.groupBy("leaf", "part").applyInPandas(_compare(cosine), "a long, b long, links long"), "links")

    links = found.filter("b IS NULL").groupBy(F.col("a").alias("c")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "c")
    named = classes.join(links, "c", "left").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    names = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(names, "root").select(
        F.col("embedding").alias("e"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component"
    )
    joined = rows.join(named, F.col("fine") & (F.col("embedding") == F.col("e")), "left")
    return joined.select(
        "id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("e").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
    )
