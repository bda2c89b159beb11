"""Small files on any file system Spark reaches, through Hadoop's own API."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Folder:
    """A folder and names below it."""

    spark: SparkSession
    path: str

    def _hadoop(self):
        return self.spark.sparkContext._jvm.org.apache.hadoop

    def _at(self, name: str):
        return self._hadoop().fs.Path(f"{self.path}/{name}" if name else self.path)

    def _system(self):
        return self._at("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, name: str = "") -> list[str]:
        """Names in a folder; none if it is not there."""
        system, path = self._system(), self._at(name)
        return [entry.getPath().getName() for entry in system.listStatus(path)] if system.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._system().open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Make a file with this text appear under its name at once; False if the name is taken.

        The text is written under a name of its own first. A shared file system then renames it in one step that
        never replaces a file; on the driver's own disk, where Hadoop looks and renames in two steps, a hard link does.
        """
        system, temporary = self._system(), f"{name.rpartition('/')[0]}/_{uuid.uuid4().hex}"
        stream = system.create(self._at(temporary), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        try:
            if system.getScheme() == "file":
                return self._link(temporary, name)
            return self._rename(system, temporary, name)
        finally:
            if system.exists(self._at(temporary)):
                system.delete(self._at(temporary), False)

    def _link(self, source: str, name: str) -> bool:
        try:
            os.link(self._at(source).toUri().getPath(), self._at(name).toUri().getPath())
            return True
        except FileExistsError:
            return False

    def _rename(self, system, source: str, name: str) -> bool:
        fs = self._hadoop().fs
        options = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
        context = fs.FileContext.getFileContext(system.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(self._at(source), self._at(name), options)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            return False

    def delete(self, name: str) -> None:
        self._system().delete(self._at(name), True)
