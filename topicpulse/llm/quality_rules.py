"""Quality rules with risk-controlled cutoffs.

Every rule rejects a document whose measure is above a cutoff.  The cutoff is chosen for each
stratum on labelled documents, such that good ones are rejected with a chance of at most
``risk``, and the whole table of cutoffs is right with a probability of ``1 - error``:

* the candidates of a rule are a fixed grid, tested from the loosest on, and the first that
  fails ends the rule (a fixed sequence needs no correction),
* a candidate that rejects k of the n good documents passes if the exact binomial probability
  of k or fewer at ``risk`` is at most ``error`` divided by the number of strata and rules.

Among the candidates that pass, the one that separates bad from good labels best is taken, and
the loosest of equals.  A rule without such a candidate rejects nothing in its stratum.

All of it is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from topicpulse.llm.common import cut, words_of

RISK = 0.005
ERROR = 0.05
# Cutoffs of a rule: so many steps, each smaller by this factor than the one before.
GRID_STEPS = 60
GRID_FACTOR = 0.9
# Tables of cutoffs up to so many strata are broadcast.
BROADCAST_STRATA = 10_000

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
POSITION_BITS = 24

# The measure of each rule, as a numerator and a denominator, and its loosest cutoff.
RULES = {
    "symbols": ("n_symbols", "word_chars", 1.0),
    "dup_lines": ("n_dup_lines", "n_lines", 1.0),
    "repeats": ("n_repeat_words", "n_words", 1.0),
    "long_words": ("word_chars", "n_words", 1000.0),
}


def _measure_of(rule: str) -> Column:
    above, below, _ = RULES[rule]
    return F.col(above) / F.greatest(F.col(below), F.lit(1))


def _window_keys(words: Column) -> Column:
    """A key for each window of three words: its hash and, in the low bits, where it starts."""
    return F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.shiftleft(
                F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
                POSITION_BITS,
            ).bitwiseOR(i.cast("long")),
        ),
    )


def _same(words: Column, one: Column, other: Column) -> Column:
    """Whether two keys have one hash and the windows are equal word by word."""
    mask = (1 << POSITION_BITS) - 1
    a, b = one.bitwiseAND(mask).cast("int"), other.bitwiseAND(mask).cast("int")
    same_hash = F.shiftrightunsigned(one, POSITION_BITS) == F.shiftrightunsigned(
        other, POSITION_BITS
    )
    return F.when(
        same_hash,
        (F.get(words, a) == F.get(words, b))
        & (F.get(words, a + 1) == F.get(words, b + 1))
        & (F.get(words, a + 2) == F.get(words, b + 2)),
    )


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang"
) -> DataFrame:
    """``doc_id, stratum`` and the counts of a text: ``n_words, word_chars, n_symbols, n_lines``
    (lines with a word), ``n_dup_lines, n_repeat_words``.

    A null text is an empty one, with zeros.  Texts over 16 million words are out of range of
    the window positions and raise an error.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    packed = F.translate(text, SPACES, "")
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(stratum_col).cast("string").alias("stratum"),
        words_of(F.col(text_col)).alias("words"),
        lines.alias("lines"),
        packed.alias("packed"),
    ).select(
        "doc_id",
        "stratum",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length("packed").cast("long").alias("word_chars"),
        (F.length("packed") - F.length(F.translate("packed", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    low = (1 << POSITION_BITS) - 1
    sound = F.when(
        F.size("words") > low, F.raise_error(F.lit("a text has too many words"))
    ).otherwise(F.sort_array(_window_keys(F.col("words"))))
    keyed = counted.withColumn("keys", sound)
    repeated = F.filter(
        "keys",
        lambda x, i: _same(F.col("words"), x, F.get("keys", i - 1))
        | _same(F.col("words"), x, F.get("keys", i + 1)),
    )
    places = keyed.withColumn(
        "places", F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(low)))
    )
    # A window adds three words, or fewer if the one before reaches into it.
    covered = F.transform(
        "places", lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get("places", i - 1), p - 3))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b)
    return places.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def tail_probability(n: Column, k: Column, risk: float) -> Column:
    """The binomial probability of ``k`` or fewer in ``n`` at ``risk``; 1 from the mean on.

    The terms follow from each other, in logarithms.
    """
    odds = math.log(risk) - math.log1p(-risk)
    start = F.struct(
        (n * math.log1p(-risk)).alias("term"), F.exp(n * math.log1p(-risk)).alias("total")
    )

    def step(held, j):
        term = held["term"] + F.log((n - j + 1) / j) + F.lit(odds)
        return F.struct(term.alias("term"), (held["total"] + F.exp(term)).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    total = F.aggregate(steps, start, step, lambda held: held["total"])
    return F.when(k >= n * risk, F.lit(1.0)).otherwise(total)


def first_step(rule: str) -> Column:
    """The first cutoff on the grid, from the loosest on, that a document is above."""
    value, loosest = _measure_of(rule), RULES[rule][2]
    steps = F.floor(F.log(value / F.lit(loosest)) / F.lit(math.log(GRID_FACTOR))) + 1
    step = (
        F.when(value > loosest, F.lit(0))
        .when(value <= 0, F.lit(GRID_STEPS))
        .otherwise(F.greatest(F.lit(0), steps))
    )
    return F.least(F.lit(GRID_STEPS), step).cast("int")


def calibrate(
    measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR
) -> DataFrame:
    """``stratum, rule, step, cutoff``: the rules that may reject, from labelled documents.

    Documents that fail the base rules are left out, as no cutoff decides on them.  Labels
    that aren't 0 or 1 and rows without id don't count; an id with several labels counts as
    the highest.
    """
    marked = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    rows = measured.filter(~base_failed()).join(marked, "doc_id")

    # ``step``: the first cutoff on the grid, from the loosest on, that rejects the document.
    long = rows.select(
        "stratum",
        "quality",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(rule).alias("rule"), first_step(rule).alias("step"))
                    for rule in RULES
                ]
            )
        ),
    )
    counts = long.groupBy("stratum", "rule", "step").agg(
        F.count(F.when(F.col("quality") == 1, 1)).alias("good"),
        F.count(F.when(F.col("quality") == 0, 1)).alias("bad"),
    )
    grid = (
        counts.select("stratum", "rule")
        .distinct()
        .select("stratum", "rule", F.explode(F.sequence(F.lit(0), F.lit(GRID_STEPS))).alias("step"))
    )
    keys = ["stratum", "rule", "step"]
    full = grid.join(
        counts.withColumnRenamed("stratum", "_stratum"),
        F.col("stratum").eqNullSafe(F.col("_stratum"))
        & (grid["rule"] == counts["rule"])
        & (grid["step"] == counts["step"]),
        "left",
    ).select(*[grid[k] for k in keys], F.coalesce("good", F.lit(0)).alias("good"),
             F.coalesce("bad", F.lit(0)).alias("bad"))
    one = Window.partitionBy("stratum", "rule")
    so_far = one.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    families = counts.select("stratum", "rule").distinct().count() or 1
    tested = (
        full.withColumn("n_good", F.sum("good").over(one))
        .withColumn("n_bad", F.sum("bad").over(one))
        .withColumn("cut_good", F.sum("good").over(so_far))
        .withColumn("cut_bad", F.sum("bad").over(so_far))
        .filter(F.col("step") < GRID_STEPS)
        .withColumn("chance", tail_probability(F.col("n_good"), F.col("cut_good"), risk))
        .withColumn("worst", F.max("chance").over(so_far))
        .filter(F.col("worst") <= error / families)
        .withColumn(
            "gain",
            F.col("cut_bad") / F.greatest("n_bad", F.lit(1))
            - F.col("cut_good") / F.greatest("n_good", F.lit(1)),
        )
        .filter(F.col("gain") > 0)
    )
    best = tested.groupBy("stratum", "rule").agg(
        F.min(F.struct((-F.col("gain")).alias("loss"), "step")).alias("best")
    )
    loosest = F.create_map(*[F.lit(x) for r, (_, _, top) in RULES.items() for x in (r, top)])
    return best.select(
        "stratum",
        "rule",
        F.col("best.step").alias("step"),
        (F.element_at(loosest, F.col("rule")) * F.pow(F.lit(GRID_FACTOR), "best.step")).alias(
            "cutoff"
        ),
    )


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed``, ``kept`` and ``rejected_by``, the rules that reject."""
    chosen = cutoffs.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "step"))).alias("_steps")
    )
    chosen = chosen.withColumnRenamed("stratum", "_stratum")
    if chosen.count() <= BROADCAST_STRATA:
        chosen = F.broadcast(chosen)
    joined = measured.join(chosen, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    rejecting = F.array_compact(
        F.array(
            *[
                F.when(first_step(rule) <= F.element_at("_steps", rule), F.lit(rule))
                for rule in RULES
            ]
        )
    )
    return joined.select(
        *measured.columns,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.size(rejecting) == 0)).alias("kept"),
        rejecting.alias("rejected_by"),
    )


def apply_rules(
    docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR
) -> DataFrame:
    """``doc_id, stratum``, the counts of ``measure``, ``base_failed, kept, rejected_by``.

    One row for every row of ``docs``, whatever repeats.  A null stratum is a stratum of its
    own.  Without labels only the base rules decide.
    """
    measured = cut(measure(docs))
    return judge(measured, cut(calibrate(measured, labels, risk, error)))
