"""The n-gram model against plain Python, and what must hold for any such model."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import plain
from topicpulse.llm import kneser_ney
from topicpulse.operators.lineage import Stages


def tokens(text):
    return plain.WORD.findall(plain.lower_ascii(text or "")) + ["\n"]


def plain_discounts(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if not all(n):
        return (0.5, 1.0, 1.5)
    y = n[0] / (n[0] + 2 * n[1])
    d = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
    return d if all(0 <= x <= k for k, x in enumerate(d, 1)) else (0.5, 1.0, 1.5)


class Plain:
    def __init__(self, texts, order):
        self.order, self.words = order, Counter()
        grams = Counter()
        for text in texts:
            row = [" "] * (order - 1) + tokens(text)
            self.words.update(row[order - 1 :])
            grams.update(tuple(row[i : i + order]) for i in range(len(row) - order + 1))
        self.levels = {order: grams}
        for k in range(order - 1, 0, -1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.taken = {k: plain_discounts(c.values()) for k, c in self.levels.items()}
        self.follow = {k: defaultdict(list) for k in self.levels}
        for k, c in self.levels.items():
            for g, n in c.items():
                self.follow[k][g[:-1]].append(n)

    def chance(self, gram):
        if not gram:
            return 1 / (len(self.words) + 1)
        k, after = len(gram), self.follow[len(gram)].get(gram[:-1])
        lower = self.chance(gram[1:])
        if not after:
            return lower
        d = (0, *self.taken[k])
        n = self.levels[k].get(gram, 0)
        return (max(n - d[min(n, 3)], 0) + sum(d[min(x, 3)] for x in after) * lower) / sum(after)

    def score(self, text):
        row = [" "] * (self.order - 1) + tokens(text)
        chances = (self.chance(tuple(row[i : i + self.order])) for i in range(len(row) - self.order + 1))
        return sum(map(math.log10, chances))

    def base(self, text):
        below = sum(self.words.values()) + 0.1 * (len(self.words) + 1)
        return sum(math.log10((self.words[t] + 0.1) / below) for t in tokens(text))


def corpus(seed, count):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    rows = [(n, " ".join(draw.choices(words, weights, k=draw.randint(0, 40)))) for n in range(count)]
    rows += [(1000 + n, rows[3][1]) for n in range(20)] + [(2000 + n, "the the " * 30) for n in range(20)]
    rows += [(3000, None), (3001, ""), (3002, " \n\x0b"), (3003, " É Wörter\x0bMIT ÄÖ\r\nw1 \n"), (3004, "x" * 70_000)]
    rows += [(3005, "w1 w2 " * 20_000), (3006, "a\x85b a b  "), (7, "again"), (7, "again"), (None, "no id w1")]
    return rows


def trained(rows):
    return [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10]


@pytest.mark.parametrize("order, parts, held", [(2, 5000, 2_000_000), (2, 8, 500), (3, 10, 300)])
def test_scores_are_those_of_the_whole_corpus(table, monkeypatch, order, parts, held):
    monkeypatch.setattr(kneser_ney, "PARTS", parts)
    monkeypatch.setattr(kneser_ney, "TOKENS_HELD", held)
    monkeypatch.setattr(kneser_ney, "BUCKET_TOKENS", 3000)
    monkeypatch.setattr(kneser_ney, "ROW_GRAMS", 32_000 if parts == 5000 else 7)
    rows = corpus(order, 150)
    model = Plain(trained(rows), order)
    found = kneser_ney.score_corpus(table(rows).repartition(3), order)
    assert ", ".join(f"{n} {t}" for n, t in found.dtypes) == kneser_ney.RESULT
    found = found.collect()
    expected = Counter()
    for d, t in rows:
        out = d is not None and zlib.crc32(str(d).encode()) % 10 == 0
        known = sum(model.words[x] > 0 for x in tokens(t))
        expected[d, out, len(tokens(t)), known, sum(model.words.values()), round(model.base(t), 6), round(model.score(t), 6)] += 1
    assert Counter((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in found) == expected


@pytest.mark.parametrize("order", [2, 3])
def test_chances_after_any_context_add_up_to_one(spark, table, order):
    stages = Stages(spark)
    model = kneser_ney.fit(table(corpus(5, 100)), stages, order)
    scorer = kneser_ney.Scorer(model)
    words = [f"w{k}".encode() for k in range(60)]
    known = {x for _, t in corpus(5, 100) for x in tokens(t)}
    every = np.array([kneser_ney._word_hash(w.encode()) for w in [*sorted(known), "never seen"]], dtype=np.uint64)
    for before in [(b"w0", b"w1"), (b"w3", b"never"), (b" ", b" "), (b"the", b"the"), (b"w0", words[40])]:
        row = np.array([kneser_ney._word_hash(w) for w in before], dtype=np.uint64)
        rows = np.concatenate([np.append(row, w) for w in every])
        _, chances = scorer.chances(rows, np.arange(2, len(rows), 3))
        assert chances.sum() == pytest.approx(1)
    stages.release()


def test_nothing_to_learn_from(table):
    assert kneser_ney.score_corpus(table([])).count() == 0
    only = next(n for n in range(100) if zlib.crc32(str(n).encode()) % 10 == 0)
    row = kneser_ney.score_corpus(table([(only, "a b")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.base_score == pytest.approx(0) and row.score == pytest.approx(0)


def test_discounts_fall_back():
    assert kneser_ney.discounts([100, 40, 20, 10]) == plain_discounts([1] * 100 + [2] * 40 + [3] * 20 + [4] * 10)
    assert kneser_ney.discounts([5, 0, 1, 1]) == kneser_ney.FALLBACK
    assert kneser_ney.discounts([1, 50, 1, 900]) == kneser_ney.FALLBACK
