from __future__ import annotations

import collections
import math
import random

import pytest

from clickloom.llm import katz


class Slow:
    """The same model from plain dictionaries."""

    def __init__(self, docs, held):
        self.one, self.two, self.before = collections.Counter(), collections.Counter(), collections.Counter()
        for n, text in enumerate(docs):
            if not held[n]:
                tokens = self.tokens(text)
                self.one.update(tokens)
                self.two.update(zip(["<"] + tokens, tokens, strict=False))
                self.before.update(["<"] + tokens[:-1])
        self.size = sum(self.one.values())
        self.d1, self.d2 = self.discount(self.one), self.discount(self.two)
        freed = 1 - sum(self.d1(c) for c in self.one.values()) / self.size
        self.unseen = max(freed, 0.5 / (self.size + 0.5))
        self.scale = (1 - self.unseen) / (1 - freed)
        after = collections.defaultdict(list)
        for (a, b), c in self.two.items():
            after[a].append((b, c))
        self.after = after

    @staticmethod
    def tokens(text):
        return (text or "").encode().lower().split() + [b" end"]

    @staticmethod
    def discount(counts):
        n = collections.Counter(counts.values())
        top = 6 * n[6] / n[1] if n[1] else 0
        factors = [0]
        for r in range(1, 6):
            ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0
            factor = (ratio - top) / (1 - top) if top != 1 else 0
            factors.append(factor if 0 < factor < 1 else 1 - 0.5 / r)
        return lambda c: c * factors[c] if c <= 5 else c

    def single(self, word):
        return self.scale * self.d1(self.one[word]) / self.size if self.one[word] else self.unseen

    def probability(self, before, word):
        if not self.before[before]:
            return self.single(word)
        below = self.before[before] + (0 if any(c <= 5 for _, c in self.after[before]) else 0.5)
        if self.two[before, word]:
            return self.d2(self.two[before, word]) / below
        free = 1 - sum(self.d2(c) for _, c in self.after[before]) / below
        return free / (1 - sum(self.single(w) for w, _ in self.after[before])) * self.single(word)

    def score(self, text):
        tokens = self.tokens(text)
        return sum(math.log10(self.probability(*pair)) for pair in zip(["<"] + tokens, tokens, strict=False))

    def base(self, text):
        return sum(math.log10((self.one[t] + 0.5) / (self.size + 0.5 * (len(self.one) + 1))) for t in self.tokens(text))


@pytest.mark.parametrize(("known", "flush"), [(1 << 20, 4_000_000), (6, 200)])
def test_against_plain_dictionaries(spark, make_docs, odd_docs, monkeypatch, known, flush):
    monkeypatch.setattr(katz, "KNOWN", known)
    monkeypatch.setattr(katz, "LEAST_PARTITIONS", 5)
    random.seed(2)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, t) for i, t in odd_docs if i not in (6,)] + [
        (100 + n, " ".join(random.choices(vocabulary, weights=[1 / (i + 1) for i in range(60)], k=random.randint(0, 40))) + f" once{n}") for n in range(60)
    ]
    held = [i is not None and i % 5 == 1 for i, _ in docs]
    model = Slow([t for _, t in docs], held)
    rows = katz.scores(make_docs(docs), "doc_id % 5 = 1").collect()
    got = sorted((r.id is None, r.id or 0, r.n_tokens, r.n_known, r.held_out, round(r.score, 6), round(r.base_score, 6)) for r in rows)
    expected = []
    for (i, text), out in zip(docs, held, strict=True):
        tokens = model.tokens(text)
        known_tokens = sum(model.one[t] > 0 for t in tokens)
        expected.append((i is None, i or 0, len(tokens), known_tokens, out, round(model.score(text), 6), round(model.base(text), 6)))
    for a, b in zip(got, sorted(expected), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=2e-6)
    assert {r.train_tokens for r in rows} == {model.size}


def test_weights_normalise_exactly(make_docs):
    random.seed(4)
    docs = [" ".join(random.choices("abcdefgh", k=30)) for _ in range(6)] + ["z z z z z z z z z z"] * 9
    model = Slow(docs, [False] * len(docs))
    for before in list(model.before):
        total = sum(model.probability(before, w) for w in model.one) + model.probability(before, "never seen")
        assert total == pytest.approx(1, abs=1e-12)


def test_no_training_rows(spark, make_docs):
    rows = katz.scores(make_docs([(1, "a b"), (2, None)]), "true").collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in rows] == [(0, 0, 0.0)] * 2
    assert katz.scores(make_docs([(1, "a b")]).filter("false"), "true").count() == 0
