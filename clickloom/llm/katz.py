"""Katz backoff scores of whole texts: a bigram model over the corpus itself.

Good-Turing discounts apply to counts of up to `K`; what they free is given to unseen words by
weights that normalise exactly. A token's probability is that of its bigram if the bigram was
seen, else the weight of the word before it times the token's own probability, and a word never
seen in training has what unigram discounting frees.

Texts are tokenised where they lie. What moves are entries (word before, word, document, times) in
compressed columns, routed by the word before, so a partition holds all that follows its words and
can normalise them alone. Words before that are very frequent are spread by the pair instead; there
are at most `SPREAD` of them for each partition, and their totals are merged. Counts of frequent
words (at most `KNOWN` of them) are known to every task; entries of other words meet their word's
count by a join first. Scores are sums by document within a partition, then over partitions.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import saved

K = 5
KNOWN = 1 << 20  # bound of the table of frequent words that every task has
FLUSH = 1_000_000  # tokens a task gathers before it sends them on
DISTINCT = 200_000  # words a task counts before it sends the counts on
ENTRIES, LEAST_PARTITIONS = 1_000_000, 64  # training tokens aimed at in a partition, and partitions at least
SPREAD = 8
GATHER = 8  # partitions that one task scores one after the other, so that sums of a document meet before they move
_RARE = np.uint64(1 << 63)
START, END = b" start", b" end"  # no word holds a blank


def words(text: str | None) -> list[bytes]:
    """Runs between ASCII blanks after lowering A-Z; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _digest(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> 1  # 63 bits: fits a long and leaves the top bit free


# ---- columns in bytes


def _squeeze(values: np.ndarray) -> tuple[str, int, bytes]:
    """Least width, bytes of equal weight together, zstd."""
    values = np.ascontiguousarray(values)
    if values.dtype.kind == "u" and values.size:
        values = values.astype(np.min_scalar_type(values.max()))
    data = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes() if values.size else b""
    return values.dtype.str, values.size, pa.compress(data, "zstd", asbytes=True)


def _expand(kind: str, size: int, data: bytes) -> np.ndarray:
    kind = np.dtype(kind)
    if not size:
        return np.empty(0, kind)
    raw = np.frombuffer(pa.decompress(data, size * kind.itemsize, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, size).T).view(kind).reshape(size)


def _pack(columns: dict[str, np.ndarray]) -> bytes:
    return pickle.dumps({name: _squeeze(values) for name, values in columns.items()})


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    return {name: _expand(*packed) for name, packed in pickle.loads(data).items()}


def _rises(values: np.ndarray) -> np.ndarray:
    """Sorted unsigned numbers as their differences."""
    return np.diff(values, prepend=values.dtype.type(0)) if values.size else values


@dataclass
class Entries:
    """Entries with word codes; a frequent word's code is its place in the known table, another's its digest with the top bit set."""

    before: np.ndarray  # code of the word before
    word: np.ndarray  # code of the word
    count: np.ndarray  # training count of the word
    times: np.ndarray
    doc: np.ndarray  # row in `docs`
    docs: dict[str, np.ndarray]  # key, id, named (whether the id is not null), held

    def packed(self) -> bytes:
        order = np.lexsort((self.doc, self.word, self.before))
        before, runs = np.unique(self.before[order], return_counts=True)
        word, first, place = np.unique(self.word[order], return_index=True, return_inverse=True)
        rare = word >= _RARE
        used, doc = np.unique(self.doc[order], return_inverse=True)
        docs = {name: values[used] for name, values in self.docs.items()}
        return _pack(
            {
                "before": _rises(before), "runs": runs.astype(np.uint64), "word": _rises(word), "place": place.astype(np.uint64),
                "count": self.count[order][first][rare].astype(np.uint64), "times": self.times[order].astype(np.uint64),
                "doc": doc.astype(np.uint64), "id": docs["id"], "named": docs["named"].astype(np.uint64),
                "held": docs["held"].astype(np.uint64), "key": _rises(docs["key"].astype(np.uint64)),
            }
        )

    @staticmethod
    def unpacked(data: bytes, known: np.ndarray) -> Entries:
        c = _unpack(data)
        word = np.cumsum(c["word"].astype(np.uint64), dtype=np.uint64)
        rare, counts = word >= _RARE, np.zeros(word.size, np.int64)
        counts[rare] = c["count"]
        counts[~rare] = known[word[~rare].astype(np.int64)]
        before = np.repeat(np.cumsum(c["before"].astype(np.uint64), dtype=np.uint64), c["runs"].astype(np.int64))
        place = c["place"].astype(np.int64)
        docs = {"key": np.cumsum(c["key"].astype(np.uint64), dtype=np.uint64).astype(np.int64), "id": c["id"]}
        docs |= {"named": c["named"] > 0, "held": c["held"] > 0}
        return Entries(before, word[place], counts[place], c["times"].astype(np.int64), c["doc"].astype(np.int64), docs)

    @staticmethod
    def joined(parts: list[Entries]) -> Entries:
        """All entries; documents with one key are one row."""
        docs = {name: np.concatenate([p.docs[name] for p in parts]) for name in parts[0].docs}
        keys, first, place = np.unique(docs["key"], return_index=True, return_inverse=True)
        starts = np.cumsum([0, *(p.docs["key"].size for p in parts)])
        doc = np.concatenate([place[start + p.doc] for start, p in zip(starts, parts, strict=False)])
        rest = (np.concatenate([getattr(p, name) for p in parts]) for name in ("before", "word", "count", "times"))
        return Entries(*rest, doc, {name: values[first] for name, values in docs.items()})

    def take(self, which: np.ndarray) -> Entries:
        return Entries(self.before[which], self.word[which], self.count[which], self.times[which], self.doc[which], self.docs)


def _digests(some: dict) -> np.ndarray:
    """`_digest` of every key."""
    return np.fromiter(map(xxhash.xxh64_intdigest, some), np.uint64, len(some)) >> np.uint64(1)


# ---- discounts


@dataclass(frozen=True)
class Discounts:
    """Factors of counts 1 .. K, all below 1; larger counts keep all."""

    factors: tuple[float, ...]

    @staticmethod
    def of(types: dict[int, int]) -> Discounts:
        """Good-Turing from the number of types of each count up to K + 1; a factor that it can't give is 1 - 0.5 / count."""
        n = [types.get(r, 0) for r in range(K + 2)]
        top = (K + 1) * n[K + 1] / n[1] if n[1] else 0.0
        factors = []
        for r in range(1, K + 1):
            ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
            factor = (ratio - top) / (1 - top) if top != 1 else 0.0
            factors.append(factor if 0 < factor < 1 else 1 - 0.5 / r)
        return Discounts(tuple(factors))

    def kept(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        table = np.array([0.0, *self.factors, 1.0])
        return table[np.minimum(counts, K + 1)] * counts


@dataclass(frozen=True)
class Unigrams:
    """What is known of single tokens in the training part."""

    tokens: int
    types: int
    discounts: Discounts
    unseen: float  # probability of a word never seen
    scale: float

    @staticmethod
    def of(tokens: int, types: dict[int, int], distinct: int) -> Unigrams:
        discounts = Discounts.of(types)
        freed = sum(types.get(r, 0) * r * (1 - discounts.factors[r - 1]) for r in range(1, K + 1)) / tokens if tokens else 1.0
        unseen = max(freed, 0.5 / (tokens + 0.5))
        return Unigrams(tokens, distinct, discounts, unseen, (1 - unseen) / (1 - freed) if freed < 1 else 0.0)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        seen = self.scale * self.discounts.kept(counts) / max(1, self.tokens)
        return np.where(counts > 0, seen, self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


# ---- jobs


@dataclass(frozen=True)
class Known:
    """The frequent words: sorted digests, their counts, and whether a word's successors are spread by the pair."""

    digests: np.ndarray
    counts: np.ndarray
    spread: np.ndarray
    partitions: int

    def codes(self, digests: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.digests, digests)
        found = at < self.digests.size
        found[found] = self.digests[at[found]] == digests[found]
        return np.where(found, at.astype(np.uint64), digests | _RARE)

    def is_spread(self, codes: np.ndarray) -> np.ndarray:
        frequent = codes < _RARE
        out = codes == _START
        out[frequent] = self.spread[codes[frequent].astype(np.int64)]
        return out

    def route(self, entries: Entries) -> np.ndarray:
        mixed = entries.before * np.uint64(0x9E3779B97F4A7C15)
        both = (entries.before ^ (entries.word * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
        mixed = np.where(self.is_spread(entries.before), both, mixed) >> np.uint64(24)
        return (mixed % np.uint64(self.partitions)).astype(np.int64)

    def parcels(self, entries: Entries) -> Iterator[tuple[int, bytes]]:
        """The entries packed for each partition."""
        if not entries.word.size:
            return
        to = self.route(entries)
        order = np.argsort(to, kind="stable")
        names, starts = np.unique(to[order], return_index=True)
        for name, part in zip(names, np.split(order, starts[1:]), strict=True):
            yield int(name), entries.take(part).packed()


_START = np.uint64(_digest(START)) | _RARE


def _parcel_batches(parcels: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    while some := list(islice(parcels, 64)):
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in some], pa.int32()), pa.array([d for _, d in some], pa.binary())], ["r", "data"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts of the training rows of a task: `digest, n`."""

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(_digests(counts).view(np.int64)), pa.array(list(counts.values()), pa.int64())], ["digest", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for held, text in zip(batch.column("held").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if not held:
                counts.update(words(text))
                counts[END] += 1
        if len(counts) > DISTINCT:
            yield out(counts)
            counts = Counter()
    if counts:
        yield out(counts)


class _Places(dict):
    """Numbers of words in order of appearance, behind the start and the end."""

    def __init__(self):
        super().__init__({START: 0, END: 1})

    def __missing__(self, word) -> int:
        place = self[word] = len(self)
        return place

    def of(self, text: str) -> np.ndarray:
        """A text's tokens from its start to its end."""
        own = words(text)
        out = np.empty(len(own) + 2, np.int64)
        out[0], out[-1] = 0, 1
        out[1:-1] = np.fromiter(map(self.__getitem__, own), np.int64, len(own))
        return out


def _entries(batches: Iterator[pa.RecordBatch], known: Known, rare: bool) -> Iterator[Entries]:
    """Entries of a task's documents whose words are rare, or else those whose words are not, a few million tokens at a time.

    Counts of rare words are 0 so far.
    """

    def flush() -> Entries:
        digests = _digests(table)
        codes, size = known.codes(digests), len(table)
        tokens = np.concatenate(texts)
        doc = np.repeat(np.arange(len(texts)), [t.size for t in texts])
        inner = (doc[1:] == doc[:-1]) & ((codes >= _RARE) == rare)[tokens[1:]]
        key = (doc[1:][inner] * size + tokens[:-1][inner]) * size + tokens[1:][inner]
        key, times = np.unique(key, return_counts=True)
        word, before, doc = codes[key % size], codes[key // size % size], key // (size * size)
        frequent, counts = word < _RARE, np.zeros(word.size, np.int64)
        counts[frequent] = known.counts[word[frequent].astype(np.int64)]
        keys, ids, held = (list(x) for x in zip(*rows, strict=True))
        docs = {
            "key": np.array(keys, np.int64), "id": np.array([i or 0 for i in ids], np.int64),
            "named": np.array([i is not None for i in ids]), "held": np.array(held, bool),
        }
        return Entries(before, word, counts, times, doc, docs)

    table, texts, rows, size = _Places(), [], [], 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "id", "held", "text"))
        for key, name, held, text in zip(*columns, strict=True):
            texts.append(table.of(text))
            rows.append((key, name, held))
            size += texts[-1].size
            if size >= FLUSH:
                yield flush()
                table, texts, rows, size = _Places(), [], [], 0
    if texts:
        yield flush()


def _grouped(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[tuple[int, Entries]]:
    """All entries of one partition number after the other, from parcels in order of that number."""
    at, parts = None, []
    for batch in batches:
        for r, data in zip(batch.column("r").to_pylist(), batch.column("data"), strict=True):
            if r != at and parts:
                whole, parts = Entries.joined(parts), []  # the parts are let go before the whole is used
                yield at, whole
            at = r
            parts.append(Entries.unpacked(data.as_py(), known.counts))
    if parts:
        whole, parts = Entries.joined(parts), []
        yield at, whole


@dataclass
class Pairs:
    """The distinct pairs of some entries, in order of the word before."""

    before: np.ndarray  # codes of the distinct words before
    of: np.ndarray  # row in `before` of each pair
    counts: np.ndarray  # training count of each pair
    word_counts: np.ndarray  # training count of each pair's word
    place: np.ndarray  # pair of each entry

    @staticmethod
    def of_entries(e: Entries) -> Pairs:
        before, i = np.unique(e.before, return_inverse=True)
        word, j = np.unique(e.word, return_inverse=True)
        pair, first, place = np.unique(i * word.size + j, return_index=True, return_inverse=True)
        trained = np.where(e.docs["held"][e.doc], 0, e.times)
        counts = np.bincount(place, trained, pair.size).astype(np.int64)
        return Pairs(before, pair // word.size, counts, e.count[first], place)

    def totals(self, unigrams: Unigrams) -> np.ndarray:
        """For each word before: its tokens, those of pairs above K, types of counts 1 .. K, probability of seen words."""
        size = self.before.size
        rows = [np.bincount(self.of, self.counts, size), np.bincount(self.of, np.where(self.counts > K, self.counts, 0), size)]
        rows += [np.bincount(self.of, self.counts == r, size) for r in range(1, K + 1)]
        rows.append(np.bincount(self.of, np.where(self.counts > 0, unigrams.probability(self.word_counts), 0.0), size))
        return np.stack(rows, axis=1).astype(np.float64)


def _weights(totals: np.ndarray, discounts: Discounts, unigrams: Unigrams) -> tuple[np.ndarray, np.ndarray]:
    """Denominator and backoff weight of each word before.

    A word all of whose pairs are above K frees nothing; half a token is set aside for it, so that no
    text is impossible. A word before without training tokens backs off entirely.
    """
    tokens, seen = totals[:, 0], totals[:, -1]
    kept = totals[:, 1] + totals[:, 2:-1] @ (np.array(discounts.factors) * np.arange(1, K + 1))
    below = tokens + np.where(totals[:, 2:-1].sum(axis=1) > 0, 0.0, 0.5)
    free = np.where(tokens > 0, 1 - kept / below, 1.0)
    return below, free / np.maximum(1 - seen, unigrams.unseen)


def _table(make: Callable, known, others: tuple = ()) -> Callable:
    """`make(batches, known, *others)` over a broadcast known table."""
    return lambda batches: make(batches, known.value, *others)


def _send(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[pa.RecordBatch]:
    for entries in _entries(batches, known, rare=False):
        yield from _parcel_batches(known.parcels(entries))


_RARE_ROWS = "digest long, before long, times long, key long, id long, named boolean, held boolean"


def _rare_rows(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[pa.RecordBatch]:
    names = ["digest", "before", "times", "key", "id", "named", "held"]
    for e in _entries(batches, known, rare=True):
        values = [(e.word ^ _RARE).view(np.int64), e.before.view(np.int64), e.times, *(e.docs[n][e.doc] for n in names[3:])]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names)


def _send_rare(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[pa.RecordBatch]:
    def flush() -> Iterator[pa.RecordBatch]:
        c = {n: np.concatenate([p[n] for p in held]) for n in held[0]}
        keys, first, doc = np.unique(c["key"], return_index=True, return_inverse=True)
        docs = {"key": keys, **{n: c[n][first] for n in ("id", "named", "held")}}
        entries = Entries(c["before"].view(np.uint64), c["digest"].view(np.uint64) | _RARE, c["n"], c["times"], doc, docs)
        yield from _parcel_batches(known.parcels(entries))

    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        held.append({n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names})
        if sum(p["key"].size for p in held) >= FLUSH // 4:
            yield from flush()
            held = []
    if sum(p["key"].size for p in held):
        yield from flush()


def _summed(batches: Iterator[pa.RecordBatch], known: Known, unigrams: Unigrams) -> Iterator[pa.RecordBatch]:
    """Each partition's entries in one parcel, its pair types by count, and the totals of words that are spread."""
    for r, entries in _grouped(batches, known):
        pairs = Pairs.of_entries(entries)
        types = np.bincount(pairs.counts[pairs.counts <= K + 1], minlength=K + 2)[1:].tolist()
        spread = known.is_spread(pairs.before)
        totals = pairs.totals(unigrams)[spread]
        columns = [
            pa.array([r], pa.int32()), pa.array([entries.packed()], pa.binary()), pa.array([types], pa.list_(pa.int64())),
            pa.array([pairs.before[spread].view(np.int64).tolist()], pa.list_(pa.int64())), pa.array([totals.tolist()], pa.list_(pa.list_(pa.float64()))),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["r", "data", "types", "spread", "totals"])


def _scored(
    batches: Iterator[pa.RecordBatch], known: Known, unigrams: Unigrams, discounts: Discounts, spread: np.ndarray, merged: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Sums by document within a partition."""
    for _, e in _grouped(batches, known):
        pairs = Pairs.of_entries(e)
        totals = pairs.totals(unigrams)
        if spread.size:
            at = np.minimum(np.searchsorted(spread, pairs.before), spread.size - 1)
            same = spread[at] == pairs.before
            totals[same] = merged[at[same]]
        below, weight = _weights(totals, discounts, unigrams)
        with np.errstate(divide="ignore"):
            direct = np.log10(discounts.kept(pairs.counts) / below[pairs.of])
        backed = np.log10(weight[pairs.of]) + np.log10(unigrams.probability(pairs.word_counts))
        score = np.where(pairs.counts > 0, direct, backed)[pairs.place]
        size = e.docs["key"].size
        sums = [np.bincount(e.doc, v * e.times, size) for v in (score, unigrams.base(e.count), np.ones(e.times.size), e.count > 0)]
        columns = [e.docs["key"], e.docs["id"], e.docs["named"], e.docs["held"], sums[0], sums[1], sums[2].astype(np.int64), sums[3].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "id", "named", "held", "score", "base", "n_tokens", "n_known"])


def scores(docs: DataFrame, held: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`id, held_out, n_tokens, n_known, train_tokens, base_score, score` for every row; logarithms to base 10.

    `held` is a condition in SQL; where it is true a row is scored but not learned from. Ids are
    integers. Null, empty and blank texts are one end token; repeated rows and null ids are documents
    like any other. An empty table gives no rows; other columns are ignored. The table must read in the
    same order each time, as Parquet does.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.expr(held), F.lit(False)).alias("held"),
        F.coalesce(text_column, F.lit("")).alias("text"),
    )
    counts = rows.select("held", "text").mapInArrow(_counted, "digest long, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    counts = saved(counts, "unigrams")
    seen = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types")).first()
    few = {r["n"]: r["count"] for r in counts.filter(F.col("n") <= K + 1).groupBy("n").count().collect()}
    unigrams = Unigrams.of(seen["tokens"], few, seen["types"])
    bins = {r["b"]: r["count"] for r in counts.groupBy(F.floor(F.log2("n")).alias("b")).count().collect()}  # 63 at most
    least, known_types = 64, 0
    while least > 0 and known_types + bins.get(least - 1, 0) <= KNOWN:
        least, known_types = least - 1, known_types + bins.get(least - 1, 0)
    frequent = counts.filter(F.col("n") >= F.lit(2**least if least < 63 else 2**63 - 1)).toArrow().sort_by("digest")  # KNOWN rows at most
    partitions = max(LEAST_PARTITIONS, math.ceil(seen["tokens"] / ENTRIES))
    number = frequent["n"].to_numpy()
    known = Known(frequent["digest"].to_numpy().astype(np.uint64), number, number * partitions * SPREAD >= seen["tokens"], partitions)
    sent = spark.sparkContext.broadcast(known)

    kind = "r int, data binary"
    rare = rows.mapInArrow(_table(_rare_rows, sent), _RARE_ROWS)
    rare = rare.join(counts.filter(F.col("n") < 2 ** min(least, 62)), "digest", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    parcels = rows.mapInArrow(_table(_send, sent), kind).unionByName(rare.mapInArrow(_table(_send_rare, sent), kind))
    parcels = parcels.repartition(partitions, "r").sortWithinPartitions("r")
    model = saved(parcels.mapInArrow(_table(_summed, sent, (unigrams,)), f"{kind}, types array<long>, spread array<long>, totals array<array<double>>"), "bigrams")

    types = model.select(F.posexplode("types").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).collect()
    discounts = Discounts.of({r["r"] + 1: r["n"] for r in types})
    spread = model.select(F.explode(F.arrays_zip("spread", "totals")).alias("x")).select("x.spread", F.posexplode("x.totals").alias("i", "v"))
    spread = spread.groupBy("spread").pivot("i", list(range(K + 3))).agg(F.sum("v")).toPandas()  # partitions * SPREAD + 1 rows at most
    codes = spread["spread"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(codes)
    merged = spread.drop(columns="spread").to_numpy(np.float64)[order]
    sums = "key long, id long, named boolean, held boolean, score double, base double, n_tokens long, n_known long"
    parcels = model.select("r", "data").coalesce(math.ceil(partitions / GATHER))
    parts = parcels.mapInArrow(_table(_scored, sent, (unigrams, discounts, codes[order], merged)), sums)
    total = parts.groupBy("key", "id", "named", "held").agg(*(F.sum(c).alias(c) for c in ("score", "base", "n_tokens", "n_known")))
    return total.select(
        F.when(F.col("named"), F.col("id")).alias("id"),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(seen["tokens"]).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
