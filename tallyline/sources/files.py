"""Files by Spark's own file systems, so a path may be local, mounted or in an object store."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_dir: bool
    size: int


class Files:
    """What the layers need of a file system; paths without a scheme are of Spark's default one."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf, self._gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _at(self, path: str | os.PathLike):
        at = self._jvm.org.apache.hadoop.fs.Path(os.fspath(path))
        return at.getFileSystem(self._conf), at

    def exists(self, path: str | os.PathLike) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def is_dir(self, path: str | os.PathLike) -> bool:
        fs, at = self._at(path)
        return fs.exists(at) and fs.getFileStatus(at).isDirectory()

    def list(self, path: str | os.PathLike) -> list[Entry]:
        """What a folder holds, by name."""
        fs, at = self._at(path)
        found = [Entry(s.getPath().getName(), s.getPath().toString(), s.isDirectory(), s.getLen()) for s in fs.listStatus(at)]
        return sorted(found, key=lambda e: e.name)

    def matching(self, folder: str | os.PathLike, pattern: str) -> list[Entry]:
        """The files of a folder whose names match, by name."""
        fs, at = self._at(folder)
        found = fs.globStatus(self._jvm.org.apache.hadoop.fs.Path(at, pattern)) or ()
        return sorted((Entry(s.getPath().getName(), s.getPath().toString(), False, s.getLen()) for s in found if s.isFile()), key=lambda e: e.name)

    def size(self, path: str | os.PathLike) -> int:
        fs, at = self._at(path)
        return fs.getContentSummary(at).getLength()

    def make(self, path: str | os.PathLike) -> None:
        fs, at = self._at(path)
        fs.mkdirs(at)

    def delete(self, path: str | os.PathLike) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def move(self, source: str | os.PathLike, target: str | os.PathLike) -> None:
        """Rename; the target must not be there."""
        fs, at = self._at(source)
        to = self._jvm.org.apache.hadoop.fs.Path(os.fspath(target))
        if fs.exists(to) or not fs.rename(at, to):
            raise OSError(f"cannot move {source} to {target}")

    def read_text(self, path: str | os.PathLike) -> str:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str | os.PathLike, text: str) -> None:
        """Write a small file under a name of its own and move it into place, so that readers see the old or the new one."""
        fs, at = self._at(path)
        own = self._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
        stream = fs.create(own, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        context.rename(fs.makeQualified(own), fs.makeQualified(at), options)
