"""Writers for result records, enriched users and the labelled graph."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from topicpulse.sources.ledger import Ledger, SharedFiles, TaskMarkers, checked_name

# Rows handed to an external system in one call.
BATCH_ROWS = 7000


def suffixed(name: str, method_name: str = "") -> str:
    """Name of a column, path or table for one run variant: ``name_variant``."""
    return f"{name}_{method_name}" if method_name else name


def export_records(
    records: DataFrame,
    location: str,
    fmt: str = "json",
    mode: str = "errorifexists",
    single_file: bool = False,
) -> None:
    """Write the result records, by default as JSON lines that must not exist yet.

    ``single_file=True`` gives a folder with one file, for formats of lines: all tasks write
    their parts, and the file system joins them in their order.
    """
    if single_file:
        return _export_one_file(records, location, fmt, mode)
    records.write.format(fmt).mode(mode).save(location)


# Formats whose files can be joined: each is a sequence of lines.
LINE_FORMATS = {"json": "json", "text": "txt", "csv": "csv"}


def _export_one_file(records: DataFrame, location: str, fmt: str, mode: str) -> None:
    """Parts are written beside ``location`` and joined there; a rename makes it appear whole."""
    if fmt not in LINE_FORMATS:
        raise ValueError(f"files of {fmt!r} can't be joined; use one of {sorted(LINE_FORMATS)}")
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r} is not for a single file")
    files = SharedFiles(records.sparkSession, location)
    if mode == "errorifexists" and files.exists(location):
        raise FileExistsError(f"{location} already exists")
    draft = f"{location}._draft-{uuid4().hex}"
    try:
        records.write.format(fmt).save(f"{draft}/parts")
        files.join(f"{draft}/parts", f"{draft}/whole/part-00000.{LINE_FORMATS[fmt]}")
        if mode == "overwrite":
            files.remove(location)
        files.rename(f"{draft}/whole", location)
    finally:
        files.remove(draft)


def enrich_users(users: DataFrame, records: DataFrame) -> DataFrame:
    """All users with their result structs, null where a user has none."""
    return users.join(records, "id", "left").withColumnRenamed("id", "id_str")


def append_enriched_users(
    users: DataFrame,
    records: DataFrame,
    location: str | None = None,
    fmt: str = "parquet",
    table: str | None = None,
    run: str | None = None,
    **options: str,
) -> None:
    """Append the enriched users to a path, a catalog table or any connector.

    With ``run``, a name of this run, rows are added to ``location`` once however often the
    run is repeated, see ``append_once``.
    """
    if run is not None:
        if not location or table:
            raise ValueError("run needs a location, and no table")
        append_once(enrich_users(users, records), location, run, fmt, **options)
        return
    writer = enrich_users(users, records).write.format(fmt).mode("append").options(**options)
    if table:
        writer.saveAsTable(table)
    elif location:
        writer.save(location)
    else:
        writer.save()


RUN = "run"


def append_once(frame: DataFrame, location: str, run: str, fmt: str = "parquet", **options: str) -> bool:
    """Add ``frame`` to a table as the rows of ``run``; False if they are there already.

    The rows go to a folder of their own, ``run=...``.  What an attempt left that ended before
    its marker is overwritten.  Each run is written by one job at a time; different ones may
    be written at once.
    """
    if RUN in frame.columns:
        raise ValueError(f"a column is named {RUN!r}, as the folders of the table are")
    ledger = Ledger(frame.sparkSession, location)
    if ledger.holds(run):
        return False
    frame.write.format(fmt).mode("overwrite").options(**options).save(f"{location}/{RUN}={run}")
    ledger.commit(run)
    return True


def read_appended(
    spark: SparkSession, location: str, schema: StructType | str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """The rows of all committed runs with their ``run``; others don't count."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    full = StructType([*schema.fields]).add(RUN, "string")
    runs = Ledger(spark, location).runs()
    if not runs:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).format(fmt).options(**options).option("basePath", location)
    return reader.load([f"{location}/{RUN}={run}" for run in runs])


def graph_nodes(labelled: DataFrame) -> DataFrame:
    """Distinct endpoints of the labelled edges."""
    return labelled.select(F.explode(F.array("Source", "Target")).alias("id")).distinct()


def publish_graph(labelled: DataFrame, location: str, mode: str = "overwrite") -> None:
    """Write the node table and the edge table, one folder per topic.

    A rerun replaces the tables, so publishing twice does not duplicate edges.
    """
    graph_nodes(labelled).write.mode(mode).parquet(f"{location}/nodes")
    labelled.write.mode(mode).partitionBy("Category").parquet(f"{location}/edges")


# Partitions of the node table, and of the edges of a topic.
NODE_PARTS, EDGE_PARTS = 16, 4
PART = "part"
NODE_SCHEMA = StructType().add("id", "string").add(PART, "integer")
EDGE_SCHEMA = (
    StructType().add("Source", "string").add("Target", "string").add("Category", "string").add(PART, "integer")
)


def newest(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key: the new one, else the stored one; of several the greatest."""
    others = [c for c in rows.columns if c not in keys]

    def tagged(frame: DataFrame, age: int) -> DataFrame:
        return frame.select(*keys, F.struct(F.lit(age).alias("_new"), *others).alias("_row"))

    both = tagged(rows, 1).unionByName(tagged(stored, 0))
    best = both.groupBy(*keys).agg(F.max("_row").alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in rows.columns])


class KeyedTable:
    """A table with one row for each key, in partitions that an upsert writes anew.

    Only partitions that new rows fall into are read and written.  They are first written
    completely beside the table (``stage``) and then put in the place of the old ones
    (``swap``), which may be repeated at any time.
    """

    def __init__(self, spark: SparkSession, location: str, schema: StructType, keys: list[str], parts: list[str]):
        self.spark, self.location, self.schema = spark, location, schema
        self.keys, self.parts = keys, parts

    def read(self, folder: str | None = None) -> DataFrame:
        folder = folder or self.location
        if not SharedFiles(self.spark, folder).exists(folder):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(folder)

    def stage(self, rows: DataFrame, folder: str) -> None:
        rows = rows.select(*self.schema.names)
        touched = rows.select(*self.parts).distinct().collect()
        stored = self.read()
        for name in self.parts:  # prunes folders; the join below is exact
            values = {r[name] for r in touched}
            asked = F.col(name).isin([v for v in values if v is not None])
            stored = stored.filter(asked | F.col(name).isNull() if None in values else asked)
        same = self.spark.createDataFrame(touched, rows.select(*self.parts).schema)
        on = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in self.parts]
        stored = stored.alias("old").join(F.broadcast(same.alias("new")), on, "left_semi")
        merged = newest(rows, stored, [*self.keys, *[c for c in self.parts if c not in self.keys]])
        self._writer(merged.repartition(*self.parts)).mode("overwrite").parquet(folder)

    def swap(self, folder: str) -> None:
        staged = self.read(folder).repartition(*self.parts)
        # Spark removes only the partitions that come anew.
        self._writer(staged).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.location)

    def _writer(self, frame: DataFrame):
        return frame.select(*self.schema.names).write.partitionBy(*self.parts)


def _graph_tables(spark: SparkSession, location: str) -> dict[str, KeyedTable]:
    return {
        "nodes": KeyedTable(spark, f"{location}/nodes", NODE_SCHEMA, ["id"], [PART]),
        "edges": KeyedTable(
            spark, f"{location}/edges", EDGE_SCHEMA, ["Source", "Target", "Category"], ["Category", PART]
        ),
    }


def merge_graph(labelled: DataFrame, location: str, run: str) -> bool:
    """Merge nodes and edges into those stored: each node and each edge of a topic stands once.

    False if ``run`` was merged before.  A run that ended half-way is finished by the next
    call, of whatever run: once its partitions are staged they only have to be swapped in
    again, and before that the tables are as they were.  One job at a time may write.
    """
    spark = labelled.sparkSession
    ledger = Ledger(spark, location)
    checked_name(run)
    _finish(spark, ledger, location)
    if ledger.holds(run):
        return False
    tables = _graph_tables(spark, location)
    part = lambda n, *keys: F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias(PART)
    rows = {
        "nodes": graph_nodes(labelled).select("id", part(NODE_PARTS, "id")),
        "edges": labelled.select("Source", "Target", "Category", part(EDGE_PARTS, "Source", "Target")),
    }
    staged = f"{location}/_staged/{run}"
    for name, table in tables.items():
        table.stage(rows[name], f"{staged}/{name}")
    Ledger(spark, staged).commit("complete")
    _finish(spark, ledger, location)
    return True


def _finish(spark: SparkSession, ledger: Ledger, location: str) -> None:
    """Swap in what is staged completely, write the markers, remove the staging folders."""
    for run in ledger.files.names(f"{location}/_staged"):
        staged = f"{location}/_staged/{run}"
        if Ledger(spark, staged).holds("complete") and not ledger.holds(run):
            for name, table in _graph_tables(spark, location).items():
                table.swap(f"{staged}/{name}")
            ledger.commit(run)
        ledger.files.remove(staged)


def read_graph(spark: SparkSession, location: str) -> tuple[DataFrame, DataFrame]:
    """The stored nodes ``id`` and edges ``Source, Target, Category``."""
    tables = _graph_tables(spark, location)
    return tables["nodes"].read().drop(PART), tables["edges"].read().drop(PART)


def batches(rows: Iterable[Row], size: int = BATCH_ROWS) -> Iterator[list[Row]]:
    """Consecutive lists of at most ``size`` rows, read lazily."""
    source = iter(rows)
    while batch := list(islice(source, size)):
        yield batch


def publish_in_batches(
    frame: DataFrame, send: Callable[[list[Row]], None], size: int = BATCH_ROWS
) -> None:
    """Hand every partition to ``send`` in batches, on the executors.

    ``send`` should upsert: a task that is retried sends its batches again.
    """

    def send_partition(rows: Iterator[Row]) -> None:
        for batch in batches(rows, size):
            send(batch)

    frame.foreachPartition(send_partition)


def publish_once(
    frame: DataFrame,
    send: Callable[[str, list[Row]], None],
    keys: list[str],
    ledger: str,
    publication: str,
    size: int = BATCH_ROWS,
) -> None:
    """Hand all rows to ``send(batch_id, rows)``, each batch once, however often this is run.

    Rows are dealt out by a hash of ``keys`` and sorted, so a batch holds the same rows under
    the same id whenever a task or the whole job runs again.  A batch that ``send`` has taken
    gets a marker in the folder ``ledger``, which all executors must share, and is not sent
    again.  Only a task that ends between the two sends its last batch twice, under the same
    id.  If the rows of a publication have changed since it began, nothing is sent.
    """
    spark, checked = frame.sparkSession, checked_name(publication)
    columns = frame.columns
    seen = F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*columns)).alias("sum"))
    total = frame.agg(seen.alias("t")).first().t
    marks, told = Ledger(spark, f"{ledger}/{checked}"), f"rows-{total.n}-{(total.sum or 0) & (2**64 - 1):x}-{size}"
    if any(run != told for run in marks.runs()):
        raise ValueError(f"the rows of publication {publication!r} are not those it began with")
    marks.commit(told)
    buckets = -(-total.n // size) or 1
    dealt = frame.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    order = ["_bucket", *keys, F.xxhash64(*columns)]
    folder = f"{ledger}/{checked}/batches"

    def send_partition(rows: Iterator[Row]) -> None:
        markers = TaskMarkers(folder)
        for bucket, own in groupby(rows, key=lambda r: r["_bucket"]):
            for number, batch in enumerate(batches(own, size)):
                name = f"{bucket}-{number}"
                if not markers.holds(name):
                    send(f"{publication}/{name}", batch)
                    markers.add(name)

    dealt.repartition("_bucket").sortWithinPartitions(*order).foreachPartition(send_partition)
