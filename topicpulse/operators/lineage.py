"""Tables written between stages, lineage cuts of loops, and the layout of iterative jobs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one in the warehouse."""
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let checkpoints go to the shared folder, whatever the master is."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut(frame: DataFrame) -> DataFrame:
    """Compute ``frame`` once into the reliable checkpoint folder.

    For loops, and for columns that must not be computed twice, as generated keys.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def observed_rows(seen: Observation) -> int | None:
    """The count ``rows`` of an observation; None if the optimiser found nothing to run there."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return None


class Stages:
    """Tables that are written once, as Parquet in the shared folder, and read several times.

    Readers get column pruning, pushed filters and sizes.  ``release`` removes the files;
    what is left goes when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"
        self.count = 0
        self.rows: dict[str, int] = {}

    def _path(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def keep(self, frame: DataFrame, name: str | None = None) -> DataFrame:
        """Write ``frame`` and read it back; with a name its rows are counted on the way."""
        target = f"{self.folder}/{self.count}"
        self.count += 1
        if name is None:
            frame.write.parquet(target)
        else:
            seen = Observation()
            frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(target)
            rows = observed_rows(seen)
            if rows is not None:
                self.rows[name] = rows
        if self.count == 1:
            path, system = self._path()
            system.deleteOnExit(path)
        return self.spark.read.schema(frame.schema).parquet(target)

    def release(self) -> None:
        if self.count:
            path, system = self._path()
            system.delete(path, True)


@contextmanager
def fixed_layout(
    spark: SparkSession, partitions: int, by_part_of_keys: bool = False
) -> Iterator[None]:
    """Settings for loops that join the same keys again and again.

    Every exchange inside uses ``partitions`` partitions and stays where it is put, so
    the state of a round is already placed for the join of the next one.  Constraint
    inference is off: it costs planning time on every round and filters nothing here.
    The caller's settings come back on exit, so results must be cut before that.
    ``by_part_of_keys`` lets joins leave sides that are both partitioned by some of the keys.
    """
    wanted = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.constraintPropagation.enabled": "false",
    }
    if by_part_of_keys:
        wanted["spark.sql.requireAllClusterKeysForCoPartition"] = "false"
    with settings(spark, wanted):
        yield


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session for a while; the caller's come back on exit."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def partitions_for(rows: int, rows_per_partition: int, least: int = 4) -> int:
    return max(least, -(-rows // rows_per_partition))
