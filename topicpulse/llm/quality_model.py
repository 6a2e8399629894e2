"""Quality scores by Bradley-Terry ranking.

A document of label 1 is preferred to one of label 0.  The score is linear in the features of
the text; its weights are learnt by logistic loss on the differences of their features, so
nothing but the order matters.  Every labelled document takes part, in the pairs with all
documents of the other label.  Documents are then accepted above a quantile of the labelled
documents' scores: as many are rejected as have label 0 among the labelled.  The reported score
is a logistic curve through the given value at that quantile.

The sums over pairs need no pairs: in a cell of scores the logistic curve is a polynomial up to
rounding, so moments of each cell, which add up over tasks, give the sums over all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topicpulse.llm.common import SENT, hand_back
from topicpulse.operators.lineage import Stages, settings

# Width of a cell of scores, and degrees of its polynomials: products of two are exact to 1e-12.
CELL, DEGREES = 2.0, 16
# Buckets that the scores are counted in to find a quantile, in each of a few rounds.
BUCKETS = 4096
RIDGE = 1e-3
ACCEPT = 0.3

FEATURES = (
    "symbols", "upper", "bangs", "digits", "marks", "beyond_ascii", "same_as_before",
    "repeated_windows", "distinct_words", "mean_length", "ending_in_symbol", "length", "no_text",
)

_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b".,;:?"
_BEYOND = bytes(range(128, 256))


def text_features(text: bytes | None) -> list[float]:
    """The features of one text, all between 0 and about 1; a null text is an empty one."""
    words = (text or b"").split()
    n = len(words)
    if not n:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    packed = text.translate(None, _SPACES)
    size = len(packed)

    def share(chars: bytes) -> float:
        return (size - len(packed.translate(None, chars))) / size

    windows = n - 2
    repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / windows if windows > 0 else 0.0
    return [
        min(1.0, 4 * share(_SYMBOLS)),
        share(_UPPER),
        min(1.0, 4 * share(b"!")),
        share(_DIGITS),
        min(1.0, 4 * share(_MARKS)),
        share(_BEYOND),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        repeated,
        len(set(words)) / n,
        min(1.0, size / n / 20),
        sum(w[-1] in _SYMBOLS for w in words) / n,
        min(1.0, math.log10(n) / 5),
        0.0,
    ]


@dataclass(frozen=True)
class RankingModel:
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    cut: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        """The score before the cut; equal rows have equal ones wherever they stand."""
        return (((features - self.centre) / self.scale) * self.weights).sum(axis=1)

    def scores(self, features: np.ndarray) -> np.ndarray:
        """0 to 1, ``ACCEPT`` at the cut."""
        raw = self.raw(features) - self.cut
        return 1 / (1 + np.exp(-np.clip(raw + math.log(ACCEPT / (1 - ACCEPT)), -50, 50)))


def _matrix(features: pa.Array) -> np.ndarray:
    rows = features.flatten().to_numpy(zero_copy_only=False)
    return rows.reshape(len(features), len(FEATURES)).astype(float)


def cell_moments(
    features: np.ndarray, quality: np.ndarray, model: RankingModel
) -> dict[tuple[int, int], np.ndarray]:
    """By label and cell: Chebyshev polynomials of the score times 1, the features and their products."""
    rows = (features - model.centre) / model.scale
    at = model.raw(features) / CELL
    cells = np.floor(at)
    basis = np.cos(np.arccos(np.clip(2 * (at - cells) - 1, -1, 1))[:, None] * np.arange(DEGREES))
    found = {}
    for label in (0, 1):
        for cell in np.unique(cells[quality == label]):
            mine = (quality == label) & (cells == cell)
            own, z = basis[mine], rows[mine]
            products = (z[:, :, None] * z[:, None, :]).reshape(len(z), -1)
            values = np.hstack([np.ones((len(z), 1)), z, products])
            found[label, int(cell)] = own.T @ values
    return found


def _added(parts: Iterator[dict]) -> dict:
    total: dict = {}
    for part in parts:
        for key, values in part.items():
            total[key] = total[key] + values if key in total else values
    return total


def pair_sums(moments: dict[tuple[int, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Means over all pairs: the slope and the bend of the logistic loss, from cell moments."""
    places = np.cos(np.pi * (np.arange(DEGREES) + 0.5) / DEGREES)
    to_places = np.cos(np.arccos(places)[:, None] * np.arange(DEGREES)) * 2 / DEGREES
    to_places[:, 0] /= 2

    def side(label: int) -> tuple[np.ndarray, np.ndarray]:
        own = sorted(cell for kind, cell in moments if kind == label)
        at = [(cell + (places + 1) / 2) * CELL for cell in own]
        return np.concatenate(at), np.vstack([to_places @ moments[label, cell] for cell in own])

    (high, better), (low, worse) = side(1), side(0)
    n = len(FEATURES)
    slope, bend = np.zeros(n), np.zeros((n, n))
    for k in range(0, len(high), DEGREES):
        # A few scores against all of the other label.
        part = better[k : k + DEGREES]
        chance = 1 / (1 + np.exp(np.clip(high[k : k + DEGREES, None] - low, -50, 50)))
        first, second = chance @ worse[:, : n + 1], (chance * (1 - chance)) @ worse
        slope += part[:, 1 : n + 1].T @ first[:, 0] - first[:, 1:].T @ part[:, 0]
        met = part[:, 1 : n + 1].T @ second[:, 1 : n + 1]
        own = part[:, n + 1 :].T @ second[:, 0] + second[:, n + 1 :].T @ part[:, 0]
        bend += own.reshape(n, n) - met - met.T
    count = better[:, 0].sum() * worse[:, 0].sum()
    return slope / count, bend / count


def _sums(parts: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    for (label, cell), values in _added(parts).items():
        yield pa.RecordBatch.from_pydict({"label": [label], "cell": [cell], "sums": [values.tobytes()]})
    hand_back()


def _read(rows: list[dict]) -> Iterator[dict]:
    return ({(r["label"], r["cell"]): np.frombuffer(r["sums"]).reshape(DEGREES, -1)} for r in rows)


def _moments_of(points: DataFrame, model: RankingModel) -> dict[tuple[int, int], np.ndarray]:
    """The moments of all ``features, quality``: added up in each task, then by cell."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sums(
            cell_moments(_matrix(b.column("features")), b.column("quality").to_numpy(), model)
            for b in batches
            if b.num_rows
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sums(part for b in batches for part in _read(b.to_pylist()))

    schema = "label bigint, cell bigint, sums binary"
    parts = points.mapInArrow(measure, schema).repartition("label", "cell")
    return _added(_read([r.asDict() for r in parts.mapInArrow(add, schema).collect()]))


def _quantile(ranked: DataFrame, share: float, better: int, worse: int) -> float:
    """The middle between the score at which ``share`` of the mass is reached and the next one.

    Each label has its share of the mass.  Buckets are counted and the one that reaches the share
    is divided again, until it holds one score only.  Of equal scores those of label 1 come first.
    """
    masses = (1 - share) / better, share / worse
    wanted, below, after = share - 1e-9, 0.0, None
    low, high = ranked.agg(F.min("raw"), F.max("raw")).first()
    while True:
        width = (high - low) / BUCKETS
        at = F.least(F.floor((F.col("raw") - low) / width), F.lit(BUCKETS - 1)) if width else F.lit(0)
        buckets = (
            ranked.filter(F.col("raw").between(low, high))
            .groupBy(at.alias("bucket"))
            .agg(
                F.count_if(F.col("quality") == 1).alias("better"),
                F.count_if(F.col("quality") == 0).alias("worse"),
                F.min("raw").alias("low"),
                F.max("raw").alias("high"),
            )
            .orderBy("bucket")
            .collect()
        )
        for k, found in enumerate(buckets):
            mass = found["better"] * masses[0] + found["worse"] * masses[1]
            if below + mass >= wanted or k == len(buckets) - 1:
                break
            below += mass
        if k + 1 < len(buckets):
            after = buckets[k + 1]["low"]
        low, high = found["low"], found["high"]
        if low == high or not width:
            last = masses[1] if found["worse"] else masses[0]
            following = low if below + mass - last >= wanted or after is None else after
            return (low + following) / 2


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def _features_column(text: Column) -> Column:
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            rows = [text_features(v.as_py()) for v in part]
            yield pa.array(rows, type=pa.list_(pa.float64()))
        hand_back()

    return F.arrow_udf(run, "array<double>")(text.cast("string").cast("binary"))


def _measured(docs: DataFrame, stages: Stages) -> DataFrame:
    """``doc_id, features`` of every row, written once."""
    with settings(docs.sparkSession, SENT):
        return stages.keep(docs.select("doc_id", _features_column(F.col("text")).alias("features")))


def _fitted(measured: DataFrame, labels: DataFrame, stages: Stages) -> RankingModel | None:
    labelled = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    totals = {r["quality"]: r["count"] for r in labelled.groupBy("quality").count().collect()}
    if len(totals) < 2:
        return None
    points = stages.keep(
        measured.join(labelled, "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.struct("features", "quality")).alias("row"))
        .select("row.*")
    )
    values = [F.get("features", F.lit(k)) for k in range(len(FEATURES))]
    counts = [F.count_if(F.col("quality") == label) for label in (1, 0)]
    better, worse, *both = points.agg(*counts, *map(F.avg, values), *map(F.stddev_pop, values)).first()
    if not better or not worse:
        return None
    centre, scale = np.array(both).reshape(2, -1)
    model = RankingModel(np.zeros(len(FEATURES)), centre, np.maximum(scale, 1e-3), 0.0)
    for _ in range(30):
        slope, bend = pair_sums(_moments_of(points, model))
        step = np.linalg.solve(bend + RIDGE * np.eye(len(slope)), slope - RIDGE * model.weights)
        model = replace(model, weights=model.weights + step)
        if np.abs(step).max() < 1e-9:
            break
    raw = _by_row(model.raw)(F.col("features")).alias("raw")
    ranked = stages.keep(points.select("quality", raw))
    share_worse = totals[0] / (totals[0] + totals[1])
    return replace(model, cut=_quantile(ranked, share_worse, better, worse))


def fit(docs: DataFrame, labels: DataFrame) -> RankingModel | None:
    """The model, from all labelled documents that are not held out; None without both labels.

    Rows without id or label are left out.  An id with several labels counts as the highest.
    Features are written and joined with the labels, so no text moves, and only sums over the
    labelled documents come to the driver.
    """
    stages = Stages(docs.sparkSession)
    try:
        return _fitted(_measured(docs, stages), labels, stages)
    finally:
        stages.release()


def _by_row(value: Callable[[np.ndarray], np.ndarray]) -> Callable[[Column], Column]:
    """A number for each row of features."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(value(_matrix(part)))
        hand_back()

    return F.arrow_udf(run, "double")


def score_column(text: Column, model: RankingModel | None) -> Column:
    """The score of a text; 1 for all if there is no model."""
    if model is None:
        return F.lit(1.0)

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            rows = np.array([text_features(v.as_py()) for v in part], dtype=float)
            yield pa.array(model.scores(rows.reshape(len(part), len(FEATURES))))
        hand_back()

    return F.arrow_udf(run, "double")(text.cast("string").cast("binary"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null and empty texts are scored as texts without words.  Without labels of both kinds all
    documents are accepted.  Other columns are not looked at.  The features that the model is
    fitted on are those that are scored.
    """
    stages = Stages(docs.sparkSession)
    measured = _measured(docs, stages)
    model = _fitted(measured, labels, stages)
    value = F.lit(1.0) if model is None else _by_row(model.scores)(F.col("features"))
    return measured.select("doc_id", value.alias("score")).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are accepted, with all their columns."""
    model = fit(docs, labels)
    return docs.filter(score_column(F.col("text"), model) >= ACCEPT)
