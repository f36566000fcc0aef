"""Small files on whatever file system a path names: claims and manifests.

Data is read and written by Spark; these files only say what of it counts."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def numbers(names: list[str], ending: str = "") -> list[int]:
    """The names that are a number and ``ending``, as sorted numbers."""
    stems = [n[:len(n) - len(ending)] for n in names if n.endswith(ending)]
    return sorted(int(s) for s in stems if s.isdigit())


class Folder:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        path = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def create(self, name: str, text: str = "") -> None:
        """Fails if the file exists: of two that try, one succeeds."""
        out = self._fs.create(self._at(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def publish(self, name: str, text: str) -> None:
        """A file that readers see whole or not at all; fails if it exists."""
        if self.exists(name):
            raise FileExistsError(f"{self.root}/{name}")
        staged = f"_staged/{uuid.uuid4().hex}"
        self.create(staged, text)
        self._fs.mkdirs(self._at(name).getParent())
        if not self._fs.rename(self._at(staged), self._at(name)):
            raise OSError(f"{self.root}/{name} cannot be written")

    def claim(self, folder: str, first: int = 0) -> int:
        """The next free number of a folder, taken by exclusive creation."""
        taken = numbers(self.names(folder))
        number = taken[-1] + 1 if taken else first
        while True:
            try:
                self.create(f"{folder}/{number}")
                return number
            except Exception:
                if not self.exists(f"{folder}/{number}"):
                    raise  # not taken by another: a real failure
                number += 1

    def move(self, old: str, new: str) -> None:
        """A folder that a writer has finished takes its place."""
        self._fs.mkdirs(self._at(new).getParent())
        if self.exists(new) or not self._fs.rename(self._at(old), self._at(new)):
            raise OSError(f"{self.root}/{new} cannot be written")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
