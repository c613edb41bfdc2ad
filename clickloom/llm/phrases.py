"""Phrase collocations by prefix-free parsing: count inside distinct chunks, weighted by how often they occur.

A text is cut wherever the hash of a window of `longest - 1` tokens says so, hence equal passages are
cut alike wherever they stand. Neighbouring chunks overlap by that window, and the text's end is padded
with a window of marks, so a chunk owns all starts but those of its last window: a phrase of up to
`longest` words lies whole in the one chunk that owns its start and is counted once. Copies and shared
passages fold into few distinct chunks, and everything after the parse reads only those.

Phrases are counted length by length. A phrase that occurs often enough has two parts that do, one
word shorter, so phrases whose parts are not in a Bloom filter of the frequent ones are left out. The filter has a
fixed size and knows no false negatives: it saves work and never a phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import saved

LONGEST, LEAST, TOP = 5, 100, 2000
CHUNK = 32  # tokens between cuts, on average
FILTER_BITS = 26  # the Bloom filter has 2 ** 26 bits, 8 MB, at every size of the corpus
PROBES = 3
BATCH_BYTES = 1_000_000  # of text that is parsed at a time
COUNT_BYTES = 8_000_000  # of chunks that are counted at a time
HASH_BYTES = 1 << 15
BUCKETS = 64
BREAK = b"."
_BREAKS = b".,;:!?\n\v\f\r"
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + _BREAKS + b"\t", bytes(range(97, 123)) + BREAK * len(_BREAKS) + b" ")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MULTIPLIER
    return values ^ (values >> np.uint64(29))


def plain(text: bytes) -> bytes:
    """Words with A-Z lowered, and one mark between pieces, all parted by one blank."""
    text = text.translate(_PLAIN).replace(BREAK, b" . ")
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    while b". ." in text:
        text = text.replace(b". .", BREAK)
    return text.strip(b" .")


class Tokens:
    """Tokens of plain text as places in one buffer, with two 64-bit hashes each, all by numpy."""

    def __init__(self, buffer: bytes):
        self.buffer, codes = buffer, np.frombuffer(buffer, np.uint8)
        blanks = np.flatnonzero(codes == 32)
        self.starts = np.concatenate([[0], blanks + 1])
        self.ends = np.concatenate([blanks, [len(buffer)]])
        self.breaks = (self.ends - self.starts == 1) & (codes[self.starts] == BREAK[0])
        self.hashes = np.empty(len(self.starts), np.uint64)
        self.checks = np.empty(len(self.starts), np.uint64)
        first = 0
        while first < len(self.starts):  # by blocks of whole tokens, so that a long text needs no long scratch arrays
            last = max(int(np.searchsorted(self.ends, self.starts[first] + HASH_BYTES)), first + 1)
            at, stop = self.starts[first:last], int(self.ends[last - 1])
            part = codes[at[0] : stop]
            where = np.arange(at[0], stop, dtype=np.int64) - np.repeat(at, np.diff(np.append(at, stop)))
            value = _mixed(part + (where.view(np.uint64) << np.uint64(8)) + np.uint64(1))
            value[part == 32] = 0
            again = _mixed(value)  # of 0 it is 0
            self.hashes[first:last] = _mixed(np.add.reduceat(value, at - at[0]))
            self.checks[first:last] = np.add.reduceat(again, at - at[0])
            first = last


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the `size` tokens from each position; the last positions have none."""
    count = max(len(hashes) - size + 1, 0)
    out = np.full(count, seed, np.uint64)
    for i in range(size):
        out = _mixed(out + hashes[i : i + count])
    return out


def parse(tokens: Tokens, lasts: np.ndarray, overlap: int, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each chunk of texts that have `overlap` marks before each end in `lasts`."""
    cut = np.zeros(len(tokens.starts) + 1, bool)
    cut[: len(tokens.starts) - overlap + 1] = window_hashes(tokens.hashes, overlap) % np.uint64(chunk) == 0
    firsts = np.concatenate([[0], lasts[:-1]])
    for i in range(overlap):  # a text's last window always ends a chunk, and none starts in it
        cut[lasts - 1 - i] = False
    cut[firsts] = True
    starts = np.flatnonzero(cut[: len(tokens.starts)])
    ends = np.append(starts[1:], 0) + overlap
    ends[np.searchsorted(starts, firsts)[1:] - 1] = lasts[:-1]
    ends[-1] = lasts[-1]
    return starts, ends


def dictionary(docs: DataFrame, longest: int = LONGEST, chunk: int = CHUNK, group_column: str = "lang", text_column: str = "text") -> DataFrame:
    """`lang, chunk, words, times`: the distinct chunks of each language, the words they own, and how often they occur."""
    overlap = longest - 1

    def counted(langs: list[str], texts: list[bytes]) -> pa.RecordBatch:
        tokens = Tokens(b" ".join(texts))
        lasts = np.cumsum([t.count(b" ") + 1 for t in texts])
        starts, ends = parse(tokens, lasts, overlap, chunk)
        words = np.concatenate([[0], np.cumsum(~tokens.breaks)])
        owned = words[ends - overlap] - words[starts]
        found: dict[tuple, list] = {}
        for which, start, end, own in zip(np.searchsorted(lasts, starts, "right").tolist(), tokens.starts[starts].tolist(), tokens.ends[ends - 1].tolist(), owned.tolist(), strict=True):
            found.setdefault((langs[which], tokens.buffer[start:end]), [own, 0])[1] += 1
        kinds = {"lang": pa.string(), "chunk": pa.binary(), "words": pa.int64(), "times": pa.int64()}
        columns = [*zip(*found, strict=True), *zip(*found.values(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, texts, held = [], [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                text = plain(text.as_py())
                if text:
                    langs.append(lang.as_py())
                    texts.append(text + b" ." * overlap)
                    held += len(text)
                if held > BATCH_BYTES:
                    yield counted(langs, texts)
                    langs, texts, held = [], [], 0
        if texts:
            yield counted(langs, texts)

    rows = docs.select(
        F.coalesce(F.col(group_column).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    rows = rows.mapInArrow(run, "lang string, chunk binary, words long, times long")
    return rows.groupBy("lang", "chunk").agg(F.first("words").alias("words"), F.sum("times").alias("times"))


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 1)


def _bits(hashes: np.ndarray, probe: int, bits: int) -> np.ndarray:
    return _mixed(hashes + np.uint64((probe + 1) * int(_MULTIPLIER) & (1 << 64) - 1)) >> np.uint64(64 - bits)


class Filter:
    """A Bloom filter of phrases of one length; the bits are joined by Spark, so that only the filter comes to the driver."""

    def __init__(self, frequent: DataFrame, bits: int = FILTER_BITS):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = []
                for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    hashes = Tokens(phrase).hashes
                    own.append(window_hashes(hashes, len(hashes), _seed(lang))[0])
                at = np.concatenate([_bits(np.array(own, np.uint64), p, bits) for p in range(PROBES)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["cell", "bit"])

        found = frequent.select("lang", "phrase").mapInArrow(run, "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
        cells = np.zeros(1 << (bits - 6), np.int64)
        cells[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
        self.bits = bits
        self.cells = frequent.sparkSession.sparkContext.broadcast(cells.tobytes())

    def tester(self):
        """A function that tells of each hash whether it may be in the filter; made in the task."""
        cells = np.frombuffer(self.cells.value, np.uint64)

        def test(hashes: np.ndarray) -> np.ndarray:
            out = np.ones(len(hashes), bool)
            for probe in range(PROBES):
                at = _bits(hashes, probe, self.bits)
                out &= (cells[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
            return out

        return test


def _occurrences(tokens: Tokens, owned: np.ndarray, times: np.ndarray, size: int, seed: int, test) -> Iterator[tuple[bytes, int]]:
    """Each distinct phrase of `size` words that starts at an owned position, and how often it occurs."""
    count = len(tokens.starts) - size + 1
    if count < 1:
        return
    good = owned[:count].copy()
    for i in range(size):
        good &= ~tokens.breaks[i : i + count]
    if size > 1:
        known = test(window_hashes(tokens.hashes, size - 1, seed))
        good &= known[:count] & known[1 : count + 1]
    at = np.flatnonzero(good)
    if not at.size:
        return
    _, first, which = np.unique(window_hashes(tokens.hashes, size)[at], return_index=True, return_inverse=True)
    starts, ends = tokens.starts[at], tokens.ends[at + size - 1]
    checks = window_hashes(tokens.checks, size)[at]
    if not np.array_equal(checks, checks[first][which]):  # two phrases of one hash: name them by their bytes
        names: dict[bytes, int] = {}
        which = np.array([names.setdefault(tokens.buffer[s:e], len(names)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        first = np.unique(which, return_index=True)[1]
    total = np.zeros(first.size, np.int64)
    np.add.at(total, which, times[at])
    for start, end, n in zip(starts[first].tolist(), ends[first].tolist(), total.tolist(), strict=True):
        yield tokens.buffer[start:end], n


def _count(chunks: DataFrame, size: int, longest: int, known: Filter | None) -> DataFrame:
    """`lang, phrase, f` of the phrases of `size` words whose parts `known` may hold."""
    overlap = longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = known.tester() if known else None
        waiting: dict[str, tuple[list, list]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (texts, weights) in waiting.items():
                lengths = np.array([t.count(b" ") + 1 for t in texts])
                tokens = Tokens(b" ".join(texts))
                owned = np.ones(len(tokens.starts), bool)
                for i in range(overlap):
                    owned[np.cumsum(lengths) - 1 - i] = False
                times = np.repeat(np.array(weights, np.int64), lengths)
                rows = list(_occurrences(tokens, owned, times, size, _seed(lang), test))
                if rows:
                    phrases, counts = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array(phrases, pa.binary()), pa.array(counts, pa.int64())], ["lang", "phrase", "f"])
            waiting.clear()

        for batch in batches:
            for lang, text, times in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                texts, weights = waiting.setdefault(lang, ([], []))
                texts.append(text)
                weights.append(times)
                held += len(text)
                if held > COUNT_BYTES:
                    yield from flush()
                    held = 0
        yield from flush()

    found = chunks.select("lang", "chunk", "times").mapInArrow(run, "lang string, phrase binary, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(chunks: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """`lang, phrase, size, f` of all phrases of 1 to `longest` words that occur `least` times or more."""
    out, known = None, None
    for size in range(1, longest + 1):
        counted = _count(chunks, size, longest, known).filter(F.col("f") >= least).withColumn("size", F.lit(size))
        counted = saved(counted.select("lang", "phrase", "size", "f"), f"phrases{size}")
        out = counted if out is None else out.unionByName(counted)
        if size < longest:
            known = Filter(counted)
    return out


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, chunk: int = CHUNK, group_column: str = "lang", text_column: str = "text"
) -> DataFrame:
    """`lang, rank, phrase, a, l, r, n, score` of the `top` phrases of 2 to `longest` words of each language.

    Texts have A-Z lowered, are split into pieces at `.,;:!?` and line breaks and those into words at
    blanks and tabs. Null texts are empty, a null language is `und`, repeated rows count each time, other
    columns are ignored, an empty table gives no rows. A phrase of `least` occurrences or more is scored
    by its weakest cut and dropped if one that is a word longer occurs as often: then any longer one that
    does has such a one inside. Ties go to the more frequent phrase, then to the lesser in UTF-8 order.
    """
    chunks = saved(dictionary(docs, longest, chunk, group_column, text_column), "chunks")
    totals = chunks.groupBy("lang").agg(F.sum(F.col("words") * F.col("times")).alias("n"))
    phrases = frequent_phrases(chunks, least, longest).withColumn("phrase", F.col("phrase").cast("string"))
    phrases = saved(phrases, "phrases")
    words = F.split("phrase", " ", -1)
    candidates = phrases.filter("size > 1").withColumn("w", words)

    longer = candidates.filter("size > 2").select("lang", "f", F.explode(F.array(F.slice("w", F.lit(1), F.col("size") - 1), F.slice("w", F.lit(2), F.col("size") - 1))).alias("w"))
    longer = longer.groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("f").alias("inside"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(F.col("inside").isNull() | (F.col("inside") < F.col("f"))).drop("inside")

    # Every cut asks for two parts; a part's question carries the cut, and each cut meets its two answers again.
    cuts = kept.select("lang", "phrase", "size", "f", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    parts = cuts.select(
        "lang",
        F.col("phrase").alias("whole"),
        F.col("f").alias("a"),
        "k",
        F.posexplode(F.array(F.array_join(F.slice("w", F.lit(1), F.col("k")), " "), F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " "))).alias("side", "phrase"),
    )
    answers = parts.join(phrases.filter(F.col("size") < longest).select("lang", "phrase", "f"), ["lang", "phrase"])
    both = answers.groupBy("lang", "whole", "k").agg(
        F.first("a").alias("a"), F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r")
    )
    big = [F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")]
    scored = both.join(totals, "lang").withColumn("score", F.call_function("div", F.lit(1000) * big[0] * big[1], big[2] * big[3]))
    weakest = scored.groupBy("lang", F.col("whole").alias("phrase")).agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    found = saved(weakest.select("lang", "phrase", "cut.score", "cut.a", "cut.l", "cut.r", "cut.n"), "scored")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = found.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
    firsts = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = firsts.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
