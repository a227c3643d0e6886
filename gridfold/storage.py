"""Small files in whatever file system a path names, through Hadoop's client: the driver's documents."""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(ValueError):
    """Something published or recorded would change."""


class Store:
    """Files below a root. A write is complete or not there: it goes to another name first, and then is renamed."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._at(name))

    def read(self, name: str) -> bytes:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def _draft(self, name: str, content: bytes) -> str:
        folder, _, leaf = name.rpartition("/")
        part = f"{folder}/.{leaf}.{uuid.uuid4().hex[:8]}.part".lstrip("/")
        stream = self.fs.create(self._at(part), True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        return part

    def write(self, name: str, content: bytes) -> None:
        self.move(self._draft(name, content), name)

    def create(self, name: str, content: bytes) -> bool:
        """Writes a file if there is none of that name: of several writers at once one has True, the others False.

        The rename that doesn't overwrite is one step on HDFS; a local file gets its name as a hard link, which is one step too."""
        part = self._draft(name, content)
        try:
            if self.fs.getUri().getScheme() == "file":
                path = lambda x: self.spark._jvm.java.nio.file.Paths.get(self._at(x).toUri().getPath(), self._array("java.lang.String"))
                self.spark._jvm.java.nio.file.Files.createLink(path(name), path(part))
            else:
                self._rename(part, name, "NONE")
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        finally:
            self.remove(part)

    def _array(self, kind: str, *values: object):
        java = self.spark._jvm
        for x in kind.split("."):
            java = getattr(java, x)
        out = self.spark.sparkContext._gateway.new_array(java, len(values))
        for i, v in enumerate(values):
            out[i] = v
        return out

    def _rename(self, name: str, to: str, how: str) -> None:
        kind = "org.apache.hadoop.fs.Options$Rename"
        option = getattr(getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename"), how)
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self.fs.makeQualified(self._at(name)), self.fs.makeQualified(self._at(to)), self._array(kind, option))

    def move(self, name: str, to: str) -> None:
        """Rename, over a file that is there, in one step: a reader finds the old one or the new one."""
        self._rename(name, to, "OVERWRITE")

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def names(self) -> list[str]:
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self._at(""))) if self.exists() else []

    def files(self) -> list[tuple[str, int]]:
        """Path below the root, and bytes, of all files at any depth."""
        out, found = [], self.fs.listFiles(self._at(""), True)
        base = self.fs.makeQualified(self._at("")).toString().rstrip("/") + "/"
        while found.hasNext():
            x = found.next()
            out.append((x.getPath().toString().removeprefix(base), x.getLen()))
        return sorted(out)

    def sha256(self, name: str) -> str:
        return hashlib.sha256(self.read(name)).hexdigest()
