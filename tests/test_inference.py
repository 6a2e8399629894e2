"""JSON lines by the schema of a sample, against inference over every line."""

from __future__ import annotations

import json

import pytest
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from topicpulse.operators.lineage import Stages
from topicpulse.sources import inference, readers

PLAIN = {"id_str": "1", "n": 1, "user": {"name": "a", "tags": ["x"]}, "list": [{"k": 1}], "free": None}
ODD = [
    {**PLAIN, "late": 5},
    {**PLAIN, "n": 1.5},
    {**PLAIN, "n": "many"},
    {**PLAIN, "n": 3000000000},
    {**PLAIN, "user": {"name": "b", "age": 3}},
    {**PLAIN, "user": "gone"},
    {**PLAIN, "list": [{"k": 2}, {"k": 3, "deep": {"er": True}}]},
    {**PLAIN, "list": [], "free": {"now": [1, 2]}},
    {**PLAIN, "user": None, "a.b": 1, "with space": 2},
    {"only": "this"},
    {},
]


def as_line(value):
    """Without spaces, as an object that becomes a text is written without them."""
    return json.dumps(value, separators=(",", ":"))


def write(folder, rows):
    folder.mkdir()
    for n in range(3):
        (folder / f"part-{n}.json").write_text("\n".join(rows[n::3]) + "\n")
    return str(folder)


@pytest.fixture
def stages(spark):
    held = Stages(spark)
    yield held
    held.release()


@pytest.mark.parametrize("odd", [[], *[[x] for x in ODD], ODD])
def test_nothing_outside_the_sample_is_lost(spark, tmp_path, stages, odd):
    rows = [as_line(PLAIN)] * 30 + [as_line(x) for x in odd]
    source = write(tmp_path / "j", rows)
    full = spark.read.json(source)
    found = inference.read_json_lines(spark, source, stages, sample_lines=3)
    assert dict(found.dtypes) == dict(full.dtypes)
    order = lambda frame: sorted(str(r) for r in frame.select(*[f"`{c}`" for c in full.columns]).collect())
    assert order(found) == order(full)


def test_the_source_is_read_once_if_the_sample_shows_all(spark, tmp_path, stages):
    source = write(tmp_path / "j", [as_line(PLAIN)] * 9)
    assert inference.read_json_lines(spark, source, stages, sample_lines=2).count() == 9
    assert stages.count == 1
    inference.read_json_lines(spark, write(tmp_path / "k", [as_line(x) for x in [PLAIN] * 9 + ODD]), stages, 2)
    assert stages.count == 3


def test_lines_without_an_object_are_kept(spark, tmp_path, stages):
    source = write(tmp_path / "j", [as_line(PLAIN)] * 9 + ["{broken", "", "  ", '{"late": 1}'])
    found = inference.read_json_lines(spark, source, stages, sample_lines=1)
    assert found.count() == 11
    assert [r._rescued for r in found.filter("_rescued IS NOT NULL").collect()] == ["{broken"]
    assert found.filter("late = 1").count() == 1


def test_users_by_a_sample(spark, tmp_path, stages):
    lines = [json.dumps({"id": 7, "id_str": "7", "screen_name": "a"})] * 5
    lines += [json.dumps({"id": 8, "id_str": "8", "screen_name": "b", "experiment_spam": {"category_rf": "1"}})]
    source = write(tmp_path / "u", lines)
    users = readers.read_users(spark, source, stages=stages)
    assert sorted(users.columns) == ["experiment_spam", "id", "screen_name"]
    assert users.filter("experiment_spam.category_rf = '1'").first().id == "8"


def test_widening():
    a = StructType().add("x", LongType()).add("y", ArrayType(LongType()))
    b = StructType().add("y", ArrayType(DoubleType())).add("a", StringType())
    assert inference.widened(a, b) == StructType().add("a", StringType()).add("x", LongType()).add("y", ArrayType(DoubleType()))
    assert inference.widened(LongType(), a) == StringType()
