"""Arrays in the folder all executors share, mapped into memory where it is a mounted path."""

from __future__ import annotations

import io
import os
import re
import uuid

import numpy as np


def mounted_path(folder: str) -> str | None:
    """The path of a folder that is mounted on every machine, or None for another store."""
    scheme = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):/*", folder)
    if not scheme:
        return folder
    return "/" + folder[scheme.end() :] if scheme[1] == "file" else None


class ArrayStore:
    """Named arrays in a shared folder.

    A task that runs again writes the same array and puts it in the place of the first, so a
    reader sees a whole one.  A mounted folder is read by mapping; of another store (through
    the file systems of Arrow) an array is read whole when it is needed.
    """

    def __init__(self, folder: str):
        self.folder = folder
        self.path = mounted_path(folder)
        self.held: dict[str, np.ndarray] = {}

    def _remote(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder)

    def save(self, name: str, array: np.ndarray) -> None:
        draft = f"{name}.{uuid.uuid4().hex}"
        if self.path:
            os.makedirs(self.path, exist_ok=True)
            with open(f"{self.path}/{draft}", "wb") as file:
                np.save(file, array)
            os.replace(f"{self.path}/{draft}", f"{self.path}/{name}.npy")
            return
        system, path = self._remote()
        system.create_dir(path, recursive=True)
        buffer = io.BytesIO()
        np.save(buffer, array)
        with system.open_output_stream(f"{path}/{draft}") as out:
            out.write(buffer.getvalue())
        system.move(f"{path}/{draft}", f"{path}/{name}.npy")

    def load(self, name: str) -> np.ndarray | None:
        """The array, or None if no task has written it: its part was empty."""
        if self.path:
            if name not in self.held:
                file = f"{self.path}/{name}.npy"
                self.held[name] = np.load(file, mmap_mode="r") if os.path.exists(file) else None
            return self.held[name]
        system, path = self._remote()
        if not system.get_file_info(f"{path}/{name}.npy").is_file:
            return None
        with system.open_input_stream(f"{path}/{name}.npy") as source:
            return np.load(io.BytesIO(source.read()))
