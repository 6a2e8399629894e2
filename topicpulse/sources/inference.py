"""JSON lines read by the schema of a sample, without losing what the sample doesn't show.

The first lines give a schema.  All lines are parsed by it once, and a line that holds more (a
field the schema lacks, or a value that doesn't fit) is also kept as it is, in a rescue column.
Only if there are such lines is the schema widened by theirs and everything parsed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
)

from topicpulse.operators.lineage import Stages

# Lines the first schema is taken from; it changes only how often the data are read.
SAMPLE_LINES = 1000
RESCUED = "_rescued"
_UNFIT = "_unfit"


def widened(a: DataType, b: DataType) -> DataType:
    """The narrowest type for values of both, as JSON inference has it: text if all else fails."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        other = {f.name: f.dataType for f in b}
        found = {f.name: widened(f.dataType, other.get(f.name, f.dataType)) for f in a}
        found = {**other, **found}
        return StructType([StructField(n, found[n]) for n in sorted(found)])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widened(a.elementType, b.elementType))
    numbers = (LongType, DoubleType)
    return DoubleType() if isinstance(a, numbers) and isinstance(b, numbers) else StringType()


def holds_more(json: Column, kind: DataType) -> Column:
    """Whether a JSON text has a field, at any depth, that the type doesn't have.

    A field of the null type was never seen with a value, so any value is more.
    """
    if isinstance(kind, NullType):
        return json.isNotNull()
    if isinstance(kind, ArrayType):
        if not _has_fields(kind.elementType):
            return F.lit(False)
        parts = F.from_json(json, "array<string>")
        return F.coalesce(F.exists(parts, lambda part: holds_more(part, kind.elementType)), F.lit(False))
    if not isinstance(kind, StructType):
        return F.lit(False)
    names = F.array(*[F.lit(f.name) for f in kind]).cast("array<string>")
    unknown = F.size(F.array_except(F.json_object_keys(json), names)) > 0
    found = F.coalesce(unknown, F.lit(False))
    inner = [f for f in kind if _has_fields(f.dataType)]
    if inner:
        texts = F.from_json(json, StructType([StructField(f.name, StringType()) for f in inner]))
        for f in inner:
            found = found | holds_more(texts.getField(f.name), f.dataType)
    return found


def _has_fields(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _has_fields(kind.elementType)
    return isinstance(kind, (StructType, NullType))


def concrete(kind: DataType) -> DataType:
    """The type with texts in the place of what was never seen with a value."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, concrete(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(concrete(kind.elementType))
    return StringType() if isinstance(kind, NullType) else kind


def marked(kind: DataType, valued: DataType | None) -> DataType:
    """An inferred type with the null type where ``valued``, inferred without such fields, has none."""
    if isinstance(kind, StructType):
        known = {f.name: f.dataType for f in valued} if isinstance(valued, StructType) else {}
        return StructType([StructField(f.name, marked(f.dataType, known.get(f.name))) for f in kind])
    if isinstance(kind, ArrayType):
        inner = valued.elementType if isinstance(valued, ArrayType) else None
        return ArrayType(marked(kind.elementType, inner))
    return NullType() if valued is None else kind


def _inferred(spark: SparkSession, source) -> StructType:
    whole, valued = (
        StructType([f for f in reader.json(source).schema if f.name != "_corrupt_record"])
        for reader in (spark.read, spark.read.option("dropFieldIfAllNull", True))
    )
    return marked(whole, valued)


def _parsed(lines: DataFrame, schema: StructType) -> DataFrame:
    """The fields of ``schema`` and, for lines that don't fit it, the line itself."""
    full = StructType([*concrete(schema).fields, StructField(_UNFIT, StringType())])
    row = F.from_json("value", full, {"columnNameOfCorruptRecord": _UNFIT})
    unfit = F.col(f"_row.{_UNFIT}").isNotNull() | holds_more(F.col("value"), schema)
    return lines.withColumn("_row", row).select(
        *[F.col("_row").getField(f.name).alias(f.name) for f in schema],
        F.when(unfit, F.col("value")).alias(RESCUED),
    )


def read_json_lines(
    spark: SparkSession, location: str, stages: Stages, sample_lines: int = SAMPLE_LINES
) -> DataFrame:
    """All fields of all JSON lines, as inference over every line would give them.

    The rows are written by ``stages``.  Lines that are no JSON objects have null in every
    field; if there are any, they stand in the column ``_rescued``, which is else left out.
    Empty lines are skipped.  Objects in a field that is a text elsewhere become JSON text.
    """
    lines = spark.read.text(location).filter(F.trim("value") != "")
    shown = [r.value for r in lines.limit(sample_lines).collect()]
    schema = _inferred(spark, spark.sparkContext.parallelize(shown))
    rows, rescued = _written(lines, schema, stages)
    if rescued:
        # What has been rescued is read as a source of its own, so its schema is found by tasks.
        folder = f"{stages.folder}/rescued-{stages.count}"
        rows.filter(F.col(RESCUED).isNotNull()).select(RESCUED).write.text(folder)
        wide = widened(schema, _inferred(spark, folder))
        if wide != schema:
            rows, rescued = _written(lines, wide, stages)
    return rows if rescued else rows.drop(RESCUED)


def _written(lines: DataFrame, schema: StructType, stages: Stages) -> tuple[DataFrame, int]:
    seen = Observation()
    parsed = _parsed(lines, schema).observe(seen, F.count(RESCUED).alias("rescued"))
    return stages.keep(parsed), seen.get["rescued"]
