"""Harmonic packing of tokenised documents into sequences of one capacity.

Piece lengths fall into classes: class j holds lengths in (capacity / (j + 1), capacity / j], and a
bin of class j is full after j pieces, whatever their exact lengths. So a worker fills the bins of
a class without looking at any other worker or class, and the whole operator is one pass over the
input partitions: no shuffle, and a lost task is simply run again.

Documents may be cut freely, which removes the waste of the plain method: what remains of a
document after its full sequences is cut at the largest capacity / j that it still fills, so that j
such pieces fill a bin, and the rest goes on to a later class. Pieces shorter than capacity /
`classes` are laid end to end and cut where a bin ends. When a partition ends, pieces in bins that
are not full are laid end to end the same way: one padded sequence for each partition at most.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY, CLASSES, END = 2048, 32, 1
WORDS_KEPT = 300_000  # bound of a worker's word table; it is emptied when full
ROWS_HELD = 256  # documents, and pieces, that a worker holds as Python objects at a time, besides its open bins
_MARKS = b".,!?;:#%&$*|"


class _Words(dict):
    """UTF-8 words to their ids; a word is learned when it is first asked for, through the run of letters it starts with."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.normal, self.split = self.tokenizer.model, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.open_ended: set[bytes] = set()  # runs of letters whose normal form ends in something else
        # Below U+0180 nothing joins with the letter before it, so such runs are spelled letter by letter.
        normal = {c: self.normal.normalize_str(c) for c in map(chr, range(0x180)) if c.isalpha()}
        self.spelled = {ord(c): self.split.pre_tokenize_str(form)[0][0] for c, form in normal.items() if form.isalpha()}
        self.spellable = re.compile(f"[{''.join(map(chr, self.spelled))}]+").fullmatch

    def whole(self, word: bytes) -> bytes:
        return _packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    def letters(self, run: str) -> bytes:
        if self.spellable(run):
            return _packed([t.id for t in self.model.tokenize(run.translate(self.spelled))])
        form = self.normal.normalize_str(run)
        if not form[-1:].isalpha():
            self.open_ended.add(run.encode())
        return _packed([t.id for piece, _ in self.split.pre_tokenize_str(form) for t in self.model.tokenize(piece)])

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters only
            ids = _packed([t.id for t in self.model.tokenize(word.decode().lower())])
        else:
            run = word.rstrip(_MARKS)
            letters = run.decode()
            if not letters.isalpha():
                ids = self.whole(word)
            elif len(run) == len(word):
                ids = self.letters(letters)
            else:
                ids = self[run] + self[word[len(run) :]]
                if run in self.open_ended:
                    ids = self.whole(word)
        self[word] = ids
        return ids

    def clear(self) -> None:
        super().clear()
        self.open_ended.clear()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def encoder(path: str) -> Callable[[list[str]], Iterator[bytes]]:
    """Texts to their ids as little-endian unsigned 32-bit numbers, the same as encoding each text whole.

    This tokenizer never merges across blanks, nor a run of letters with the marks behind it as long as
    its normal form still ends in a letter, so words are encoded once and looked up afterwards. Words of
    other shapes are encoded as they stand. A-Z is lowered first, but not where that could make a special
    token (`<|`) or compose a letter that has no capital with a mark (U+0300 on, lead bytes CC and CD).
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
    words = _Words(path)

    def encode(texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if len(words) > WORDS_KEPT:
                words.clear()
            data = text.encode()
            if not (b"<|" in data or b"\xcc" in data or b"\xcd" in data):
                data = data.lower()
            yield b"".join(map(words.__getitem__, data.replace(b"\n", b" ").split(b" ")))

    return encode


def cut(length: int, capacity: int, classes: int) -> list[int]:
    """Lengths of a document's pieces: full sequences, then the largest unit fractions that fit, then the rest."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        j = -(-capacity // rest)  # the first j with capacity / j <= rest
        if j >= classes:
            pieces.append(rest)
            break
        pieces.append(capacity // j)
        rest -= capacity // j
    return pieces


class _Bins:
    """Open bins of one partition: a list of pieces for each class, and one run of small pieces."""

    def __init__(self, capacity: int, classes: int, partition: int):
        self.capacity, self.classes, self.made, self.base = capacity, classes, 0, partition << 36
        self.open: dict[int, list] = {}
        self.run, self.used = [], 0

    def _close(self, pieces: list) -> Iterator[tuple]:
        offset = 0
        for piece in pieces:
            yield *piece, self.base + self.made, offset
            offset += piece[2]
        self.made += 1

    def add(self, piece: tuple) -> Iterator[tuple]:
        """`piece` is (id, start, length, ids, document's tokens)."""
        j = self.capacity // piece[2]
        if j >= self.classes:
            yield from self.lay(piece)
            return
        bin_ = self.open.setdefault(j, [])
        bin_.append(piece)
        if len(bin_) == j:
            yield from self._close(self.open.pop(j))

    def lay(self, piece: tuple) -> Iterator[tuple]:
        """End to end, cut where the bin is full."""
        doc, start, length, ids, tokens = piece
        while length:
            take = min(length, self.capacity - self.used)
            self.run.append((doc, start, take, ids[: 4 * take], tokens))
            start, length, ids, self.used = start + take, length - take, ids[4 * take :], self.used + take
            if self.used == self.capacity:
                yield from self._close(self.run)
                self.run, self.used = [], 0

    def finish(self) -> Iterator[tuple]:
        for j in sorted(self.open):
            for piece in self.open[j]:
                yield from self.lay(piece)
        if self.run:
            yield from self._close(self.run)


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """`id, start, length, ids, doc_tokens, sequence_id, offset`, a row per piece; `ids` are its tokens,
    little-endian unsigned 32-bit.

    A document is its tokens and the end token, so null and empty texts are one token. Every row is
    packed, repeated rows and null ids too; sequences are named by partition and number, are gapless
    from offset 0 and are padded to the capacity by whoever reads them. An empty table gives no rows;
    other columns are ignored. `tokenizer` is a path that all workers can read.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    kinds = [("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType())]
    kinds += [("sequence_id", T.LongType()), ("offset", T.LongType())]
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)] + [T.StructField(*k) for k in kinds])
    end = struct.pack("<I", END)

    def batch_of(pieces: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*pieces, strict=True))
        arrow = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow, strict=True)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        bins = _Bins(capacity, classes, TaskContext.get().partitionId())
        out, id_type = [], pa.int64()
        for part in (batch.slice(at, ROWS_HELD) for batch in batches for at in range(0, batch.num_rows, ROWS_HELD)):
            id_type = part.column("id").type
            for doc, ids in zip(part.column("id").to_pylist(), encode(part.column("text").to_pylist()), strict=True):
                ids += end
                tokens, start = len(ids) // 4, 0
                for length in cut(tokens, capacity, classes):
                    out.extend(bins.add((doc, start, length, ids[4 * start : 4 * (start + length)], tokens)))
                    start += length
                if len(out) >= ROWS_HELD:
                    yield batch_of(out, id_type)
                    out = []
        out.extend(bins.finish())
        if out:
            yield batch_of(out, id_type)

    return rows.mapInArrow(run, schema)
