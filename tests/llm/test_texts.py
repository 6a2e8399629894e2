"""HTML extraction, quality rules, quality scores and decontamination."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from topicpulse.llm import decontaminate, html_text, quality_model, quality_rules

EDGES = [None, "", " \n ", "one", "a b c a b c", "tie tie", "tie tie", "w " * 30000, "\n\n#\n#\n"]


def test_article_without_what_surrounds_it():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
    <script>var t="</p><p>no</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice"><p>We use cookies, many of them</div>
    <article><h1>Head</h1><p><b>First &amp; bold text<br>goes\n on here &lt;b&gt;.<p>Second one, with <a href=q>a link</a>.</p>
    <aside>Beside</aside><ul><li>one<li>two</ul><div class="ad">Buy this now</div></article>
    <section id="comments"><p>A long, long comment with much text and no links at all in it.</p></section>
    <form><p>Sign up</p></form><footer>&copy; x</footer></body></html>"""
    assert html_text.main_text(page).split("\n") == [
        "Head", "First & bold text goes on here <b>.", "Second one, with a link.", "one", "two",
    ]


def test_parts_of_names_hide_no_text():
    page = """<article><h1>Head</h1><section id="related-work"><h2 id="social-history">History</h2>
    <p id="share-price">The price <math><mi>x</mi><mo>+</mo><mn>1</mn></math> of a share.</p></section>
    <div class="section-header">Start</div><div class="ad">Buy this now</div></article>"""
    assert html_text.main_text(page).split("\n") == ["Head", "History", "The price x+1 of a share.", "Start"]


def test_density_finds_unmarked_text():
    body = "".join(f"<p>{'Words that go on and on in a paragraph. ' * 5}</p>" for _ in range(5))
    links = "".join(f'<li><a href="/{i}">go to page number {i}</a></li>' for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div>{body}</div></div></body>"
    text = html_text.main_text(page)
    assert text.count("\n") == 4 and "go to page" not in text


def test_pages_of_all_kinds(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "plain &amp; simple"), (3, "u", "<p>"), (None, "u", "<b>x"),
             (4, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (5, "u", "<p>" + "long text " * 50000)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    rows = html_text.extract(frame.withColumn("text", F.lit(1))).collect()
    assert sorted((r.n_chars, r.text[:20]) for r in rows) == sorted(
        [(0, ""), (0, ""), (14, "plain & simple"), (0, ""), (1, "x"), (4, "deep"),
         (499999, "long text long text ")]
    )
    assert html_text.extract(frame.limit(0)).count() == 0


def test_base_counts(table):
    draw = random.Random(2)
    parts = ["a", "b", "c", "ab", "#", "é|", "\n", " ", "\t", "\x0b", "\xa0"]
    texts = EDGES + ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(500)]
    measured = {r.doc_id: r for r in quality_rules.measure(table(list(enumerate(texts)))).collect()}
    for n, text in enumerate(texts):
        r = measured[n]
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == plain.base_counts(text), text


@pytest.mark.parametrize("n, k", [(1000, 0), (1000, 3), (2500, 9), (40, 0), (100000, 300)])
def test_exact_tail(spark, n, k):
    chance = quality_rules.tail_probability(F.lit(n), F.lit(k).cast("long"), 0.005)
    got = spark.range(1).select(chance.alias("p")).first().p
    if n <= 2500:
        assert math.isclose(got, plain.tail_probability(n, k, 0.005), rel_tol=1e-9)
    assert 0 < got < 1


def test_cutoffs_hold_the_risk(table, labelled):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    rows, marks = [], []
    for n in range(3000):
        bad = n % 10 == 0
        symbol = "###" if bad or draw.random() < 0.001 else ""
        text = " ".join(word() + symbol for _ in range(60))
        rows.append((n, text, "en" if n % 3 else None, "s", 1))
        marks.append((n, int(not bad), 0))
    rows += [(n + 10000, t, "xx", "s", 1) for n, t in enumerate(EDGES)]
    judged = quality_rules.apply_rules(table(rows), labelled(marks)).collect()
    assert len(judged) == len(rows)
    of = {r.doc_id: r for r in judged}
    assert sum(not of[n].kept for n, good, _ in marks if good) <= 0.005 * 2700 + 1
    # A stratum of too few labels rejects nothing beyond the base rules, a large one does.
    assert all("symbols" in of[n].rejected_by for n, good, _ in marks if not good and n % 3)
    assert all(of[n].kept for n, _, _ in marks if not n % 3)
    assert all(not of[n + 10000].kept for n in range(len(EDGES)))


def test_rules_without_labels_or_rows(table, labelled):
    kept = quality_rules.apply_rules(table([(1, "w%d " % 1 * 60), (2, " ".join(map(str, range(60))))]), labelled([]))
    assert {r.doc_id: r.kept for r in kept.collect()} == {1: False, 2: True}
    assert quality_rules.apply_rules(table([]), labelled([])).count() == 0


def quality_rows():
    draw = random.Random(9)
    rows, marks = [], []
    for n in range(600):
        words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(80)]
        good = n % 5 != 0
        if not good:
            words = [w.upper() for w in words] if n % 2 else [w + "###" for w in words]
        rows.append((n, " ".join(words)))
        marks.append((n, int(good), 0))
    return rows, marks


def test_scores_on_held_out_rows(table, labelled):
    rows, marks = quality_rows()
    marks += [(None, 1, 0), (3, None, 0), (5, 0, 0), (5, 0, 0)]
    extra = [(1000 + n, t) for n, t in enumerate(EDGES)] + [(1000, "again"), (None, "x")]
    scored = quality_model.score(table(rows + extra), labelled(marks)).collect()
    assert len(scored) == len(rows) + len(extra)
    of = {r.doc_id: r for r in scored}
    held = [n for n, _ in rows if of[n].held_out]
    assert 80 < len(held) < 160
    assert all((of[n].predicted == 1) == (n % 5 != 0) for n in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    kept = quality_model.keep_good(table(rows), labelled(marks))
    assert sorted(r.doc_id for r in kept.collect()) == [n for n, _ in rows if of[n].predicted]


def test_scores_without_labels_of_both_kinds(table, labelled):
    scored = quality_model.score(table([(1, "a"), (2, None)]), labelled([(1, 1, 0), (2, 1, 0)]))
    assert [r.predicted for r in scored.collect()] == [1, 1]
    assert quality_model.score(table([]), labelled([])).count() == 0


def mixed_rows(count):
    draw = random.Random(4)
    rows = []
    for n in range(count):
        words = ["".join(draw.choices("abcdefg", k=draw.randint(1, 9))) for _ in range(draw.randint(0, 30))]
        marks = draw.choices(["", "!", "#", "7", ".", "X"], [8, 1, 1 + n % 2, 1 + n % 2, 1, 1], k=len(words))
        rows.append((n, " ".join(w + m for w, m in zip(words, marks))))
    return rows, [(n, int(n % 2 == 0 or n % 7 == 0), 0) for n in range(count)]


def plain_model(better, worse, share):
    """Newton steps over the differences of all pairs, and the quantile from all sorted scores."""
    both = np.vstack([better, worse])
    centre, scale = both.mean(0), np.maximum(both.std(0), 1e-3)
    winners, losers = (better - centre) / scale, (worse - centre) / scale
    pairs = (winners[:, None] - losers[None]).reshape(-1, both.shape[1])
    weights = np.zeros(both.shape[1])
    for _ in range(30):
        chance = 1 / (1 + np.exp(pairs @ weights))
        bend = (pairs * (chance * (1 - chance))[:, None]).T @ pairs / len(pairs)
        slope = pairs.T @ chance / len(pairs) - quality_model.RIDGE * weights
        weights = weights + np.linalg.solve(bend + quality_model.RIDGE * np.eye(len(weights)), slope)
    raw = np.concatenate([winners @ weights, losers @ weights])
    mass = np.repeat([(1 - share) / len(winners), share / len(losers)], [len(winners), len(losers)])
    order = np.argsort(raw, kind="stable")
    k = int(np.searchsorted(np.cumsum(mass[order]), share - 1e-9))
    return weights, (raw[order[k]] + raw[order[min(k + 1, len(raw) - 1)]]) / 2


@pytest.mark.parametrize("buckets", [quality_model.BUCKETS, 3])
def test_the_model_is_that_of_all_labelled_pairs(table, labelled, monkeypatch, buckets):
    """More pairs than a model was fitted on before."""
    monkeypatch.setattr(quality_model, "BUCKETS", buckets)
    rows, marks = mixed_rows(900)
    model = quality_model.fit(table(rows).repartition(3), labelled([*marks, (5000, 0, 0)]))
    fitted = [n for n, _ in rows if zlib.crc32(str(n).encode()) % 5]
    features = np.array([quality_model.text_features(rows[n][1].encode()) for n in fitted])
    good = np.array([marks[n][1] for n in fitted]) == 1
    assert good.sum() * (~good).sum() > 100_000
    # A labelled id without a document counts for the share of the labels.
    absent = int(zlib.crc32(b"5000") % 5 > 0)
    share = ((~good).sum() + absent) / (len(fitted) + absent)
    weights, cut = plain_model(features[good], features[~good], share)
    assert model.weights == pytest.approx(weights, abs=1e-9)
    assert model.cut == pytest.approx(cut, abs=1e-9)


def test_every_labelled_row_counts(table, labelled):
    """Beyond 10,000 labelled documents of a kind, those with marks are in the model too."""
    rows = [(n, "some words" if n < 12_000 else "some words !!") for n in range(12_400)]
    model = quality_model.fit(table(rows), labelled([(n, int(n < 12_000 or n % 2), 0) for n, _ in rows]))
    fitted = [n for n, _ in rows if zlib.crc32(str(n).encode()) % 5]
    found = sum(quality_model.text_features(rows[n][1].encode())[2] for n in fitted) / len(fitted)
    assert model.centre[2] == pytest.approx(found)


ITEM = "A shop sells 12 red apples for 5 dollars and Tom buys 12 of them, how much does Tom pay in all today?"


def leaks(table, benchmark_table, docs, items):
    found = decontaminate.find_leaks(table(docs), benchmark_table(items)).collect()
    return sorted((r.doc_id, r.item_id) for r in found)


def test_leaks_by_template(table, benchmark_table):
    other = "some text before it. {} and more of it after that, which is longer than it."
    renamed = ITEM.replace("12", "30").replace("5", "7").replace("Tom", "Ann").replace("dollars", "euros")
    mixed = ITEM.replace("12", "30", 1)  # equal numbers of the item, unequal ones here
    docs = [
        (1, other.format(ITEM)), (2, other.format(renamed)), (3, other.format(mixed)),
        (4, other.format(ITEM[:50])), (5, other.format(ITEM.upper().replace("TOM", "TOM"))),
        (6, None), (7, ""), (8, ITEM), (8, ITEM), (None, ITEM), (9, "12 " * 5000), (10, renamed + " " + ITEM),
    ]
    items = [(100, ITEM), (101, None), (102, ""), (103, "two words"), (100, None)]
    found = leaks(table, benchmark_table, [d for d in docs if d[0] is not None], items)
    # The whole item in capitals is a copy of it; of document 3 too few windows are left.
    assert found == [(1, 100), (2, 100), (5, 100), (8, 100), (10, 100)]
    kept = decontaminate.remove_leaks(table(docs), benchmark_table(items)).collect()
    assert sorted(r.doc_id for r in kept) == [3, 4, 6, 7, 9]


def test_short_items_and_empty_tables(table, benchmark_table):
    assert leaks(table, benchmark_table, [(1, "Two words!"), (2, "two words more")], [(5, "two words")]) == [(1, 5)]
    assert leaks(table, benchmark_table, [], [(5, "two words")]) == []
    assert leaks(table, benchmark_table, [(1, "two words")], []) == []


def test_many_windows_are_joined_by_a_shuffle(table, benchmark_table, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_DOCS", 0)
    assert leaks(table, benchmark_table, [(1, "x " + ITEM), (2, "y")], [(100, ITEM)]) == [(1, 100)]
    kept = decontaminate.remove_leaks(table([(1, "x " + ITEM), (2, "y")]), benchmark_table([(100, ITEM)]))
    assert [r.doc_id for r in kept.collect()] == [2]


def test_a_long_text_is_joined_by_a_shuffle(spark, table, benchmark_table, monkeypatch):
    """Only windows that may be found move, each with its own tokens."""
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(12_000)]
    renamed = ITEM.replace("12", "30").replace("Tom", "Ann")
    text = " ".join([*words[:6000], renamed, *words[6000:]])
    items = [(100, ITEM), (101, " ".join(words[50:80])), (102, " ".join(words[:30][::-1]))]
    docs = [(1, text), (2, text.upper()), (3, None), (4, ""), (5, "12 " * 3000)]
    assert leaks(table, benchmark_table, docs, items) == [(1, 100), (1, 101), (2, 100), (2, 101)]
    every = spark.range(200_000).select(F.xxhash64("id").alias("window"))
    left = decontaminate._may_be_found(every, every.limit(1000), 1000)
    assert 1000 <= left.count() < 3000
    assert left.join(every.limit(1000), "window").count() == 1000


QUESTION = (
    "Tom has 12 red apples and 5 green pears in the old basket. Mary takes 7 of them home on Monday "
    "and gives 3 plums back. How many pieces of fruit are there in the basket of Tom at the end?"
)


def test_a_conflict_takes_only_its_windows(table, benchmark_table):
    meet = QUESTION.replace("12", "30").replace("5", "30")
    taken = QUESTION.replace("5", "3")
    several = QUESTION.replace("Tom has", "Ann has")
    other = "Ann bought 9 blue hats and 4 red scarves in the new market. Bob left 2 of them there."
    docs = [(1, "before " + meet), (2, taken + " after"), (3, several), (4, other)]
    assert leaks(table, benchmark_table, docs, [(1, QUESTION)]) == [(1, 1), (2, 1), (3, 1)]


def test_names_without_the_case_of_the_document(table, benchmark_table):
    renamed = QUESTION.replace("Tom", "Ann").replace("Mary", "Bob")
    docs = [
        (1, renamed), (2, renamed.lower()), (3, renamed.upper()), (4, QUESTION.upper()), (5, QUESTION.lower()),
        (6, QUESTION.replace(" ", "\n")), (7, "It is so that " + renamed), (8, "Ann has 12 hats. How many are there?"),
    ]
    german = "Der Hund von Anna Berger frisst am Abend 3 Knochen und der Kater Moritz Maier trinkt am Morgen 2 Liter Milch"
    docs += [(9, german.upper()), (10, german.replace(" ", "\r\n")), (11, german.lower())]
    found = leaks(table, benchmark_table, docs, [(1, QUESTION), (2, german)])
    assert found == [*((n, 1) for n in range(1, 8)), (9, 2), (10, 2), (11, 2)]
