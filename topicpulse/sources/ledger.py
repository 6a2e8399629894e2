"""What has been written already: markers of runs and of batches, so that reruns add nothing.

A run is a name its caller gives and gives again when the job is started anew.  Its marker is
the last thing it writes: without the marker nothing of the run counts, with it the run is not
done again.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

FOLDER = "_ledger"
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def checked_name(run: str) -> str:
    """A name that can be a file and a partition value everywhere."""
    if not _NAME.fullmatch(run):
        raise ValueError(f"{run!r}: use letters, digits, '.', '_' and '-', a letter or digit first")
    return run


class SharedFiles:
    """Files and folders in any file system Spark writes to, by the driver."""

    def __init__(self, spark: SparkSession, location: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.system = self._path(location).getFileSystem(self.conf)

    def _path(self, *parts):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def exists(self, path: str) -> bool:
        return self.system.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        folder = self._path(path)
        if not self.system.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(folder))

    def remove(self, path: str) -> None:
        self.system.delete(self._path(path), True)

    def rename(self, path: str, target: str) -> None:
        if not self.system.rename(self._path(path), self._path(target)):
            raise OSError(f"{path} could not be renamed to {target}")

    def join(self, folder: str, target: str) -> None:
        """All parts of a folder in the order of their names as one file.

        Where the file system can, it hangs their blocks one after another (``concat``); else
        the bytes are streamed, in a buffer of fixed size.
        """
        parts = [self._path(folder, n) for n in self.names(folder) if n.startswith("part-")]
        whole = self._path(target)
        out = self.system.create(whole, True)
        if self.system.hasPathCapability(whole, "fs.capability.paths.concat"):
            out.close()
            full = [p for p in parts if self.system.getFileStatus(p).getLen()]
            listed = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Path, len(full))
            for n, part in enumerate(full):
                listed[n] = part
            if full:
                self.system.concat(whole, listed)
            return
        try:
            for part in parts:
                source = self.system.open(part)
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, self.conf, False)
                finally:
                    source.close()
        finally:
            out.close()


class Ledger:
    """Markers of runs beside a table."""

    def __init__(self, spark: SparkSession, location: str):
        self.files = SharedFiles(spark, location)
        self.folder = f"{location}/{FOLDER}"

    def _marker(self, run: str):
        return self.files._path(self.folder, checked_name(run))

    def holds(self, run: str) -> bool:
        return self.files.system.exists(self._marker(run))

    def runs(self) -> list[str]:
        """The committed runs by name."""
        return self.files.names(self.folder)

    def commit(self, run: str) -> None:
        """One call makes the marker, so a run is committed or not."""
        self.files.system.mkdirs(self.files._path(self.folder))
        self.files.system.createNewFile(self._marker(run))


class TaskMarkers:
    """Markers that tasks write, in a mounted folder or a store that Arrow knows."""

    def __init__(self, folder: str):
        self.folder = folder
        scheme = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):/*", folder)
        local = not scheme or scheme[1] == "file"
        self.path = ("/" + folder[scheme.end() :] if scheme else folder) if local else None

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder)

    def holds(self, name: str) -> bool:
        if self.path:
            return os.path.exists(f"{self.path}/{name}")
        store, path = self._store()
        return store.get_file_info(f"{path}/{name}").is_file

    def add(self, name: str) -> None:
        if self.path:
            os.makedirs(self.path, exist_ok=True)
            with open(f"{self.path}/{name}", "w"):
                return
        store, path = self._store()
        store.create_dir(path, recursive=True)
        store.open_output_stream(f"{path}/{name}").close()
