"""Greedy longest-match token counts by a linear automaton.

The vocabulary is a trie. Where the next symbol has no edge, the longest pieces on the way are cut
off and the failure link leads to the state that spells what is left; how many pieces that cuts off
is known beforehand, so a word is counted in one pass without building its pieces.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import set_aside

WORDS_KEPT = 400_000  # bound of a worker's table of counted words; it is emptied when full


class Automaton:
    """Counts a word's pieces under greedy longest match; a symbol outside all pieces is a piece of its own."""

    def __init__(self, vocabulary: Iterable[str]):
        pieces = set(vocabulary) - {""}
        self.edges: list[dict[str, int]] = [{}]
        ends = {0: False}
        for piece in pieces.union(*pieces):  # every symbol is a piece too
            at = 0
            for symbol in piece:
                at = self.edges[at].setdefault(symbol, len(self.edges))
                if at == len(self.edges):
                    self.edges.append({})
            ends[at] = True
        # Where a state without the next edge goes on, and how many pieces that cuts off.
        self.link, self.popped = [0] * len(self.edges), [0] * len(self.edges)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for symbol, at in self.edges[parent].items():
                queue.append(at)
                if ends.get(at):
                    self.popped[at] = 1
                    continue
                back, popped = self.link[parent], self.popped[parent]
                while symbol not in self.edges[back]:
                    back, popped = self.link[back], popped + self.popped[back]
                self.link[at], self.popped[at] = self.edges[back][symbol], popped

    def count(self, word: str) -> int:
        edges, link, popped = self.edges, self.link, self.popped
        at = pieces = 0
        for symbol in word:
            while at and symbol not in edges[at]:
                pieces, at = pieces + popped[at], link[at]
            if symbol in edges[at]:
                at = edges[at][symbol]
            else:
                pieces += 1
        while at:
            pieces, at = pieces + popped[at], link[at]
        return pieces


def byte_symbols() -> dict[int, str]:
    """The symbol of each byte in byte-level vocabularies: itself if printable in Latin-1, else the next one from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


@lru_cache(maxsize=1)
def _counter(path: str):
    """Counts texts with a table of the words met so far."""
    with open(path, encoding="utf-8") as file:
        automaton = Automaton(json.load(file)["model"]["vocab"])
    symbols, known = byte_symbols(), {}

    def count(text: str | None) -> tuple[int, int]:
        if len(known) > WORDS_KEPT:
            known.clear()
        words = (text or "").encode("utf-8", "surrogatepass").split()
        for word in set(words).difference(known):
            known[word] = automaton.count((b" " + word).decode("latin-1").translate(symbols))
        return len(words), sum(map(known.__getitem__, words))

    return count


def token_counts(docs: DataFrame, vocabulary: str | None = None, text_column: str = "text") -> DataFrame:
    """The rows with `_n_words` and `_n_tokens`; words are runs between ASCII blanks, each counted with one blank before it.

    Null, empty and blank texts count 0; repeated rows and null ids count like any row and an empty table
    gives no rows. Columns of any name pass through, but for the two, which are replaced. `vocabulary` is a byte-level tokenizer file that all workers can read.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    @F.pandas_udf("words long, tokens long")
    def counted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(map(_counter(path), texts)), columns=["words", "tokens"])

    kept, back = set_aside(docs.drop("_n_words", "_n_tokens"), "_n")
    rows = kept.withColumn("_n", counted(F.col(text_column)))
    return rows.select(*back, F.col("_n.words").alias("_n_words"), F.col("_n.tokens").alias("_n_tokens"))
