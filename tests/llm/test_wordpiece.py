from __future__ import annotations

import json
import random

import public_tokenizers

from clickloom.llm import wordpiece


def greedy(pieces, word):
    count = i = 0
    while i < len(word):
        i = max((j for j in range(i + 1, len(word) + 1) if word[i:j] in pieces), default=i + 1)
        count += 1
    return count


def test_automaton_is_greedy():
    random.seed(1)
    for _ in range(2000):
        pieces = {"".join(random.choices("abc", k=random.randint(1, 6))) for _ in range(random.randint(0, 8))}
        word = "".join(random.choices("abcd", k=random.randint(0, 14)))
        assert wordpiece.Automaton(pieces).count(word) == greedy(pieces.union(*pieces), word)


def test_counts(spark, make_docs, odd_docs):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        pieces = set(json.load(file)["model"]["vocab"])
    symbols = wordpiece.byte_symbols()
    rows = wordpiece.token_counts(make_docs(odd_docs)).select("doc_id", "text", "_n_words", "_n_tokens").collect()
    assert len(rows) == len(odd_docs)
    for r in rows:
        words = (r.text or "").encode().split()
        known = {w: greedy(pieces, "".join(symbols[b] for b in b" " + w)) for w in set(words)}
        assert (r._n_words, r._n_tokens) == (len(words), sum(known[w] for w in words))
    assert wordpiece.token_counts(make_docs(odd_docs).filter("false")).count() == 0
