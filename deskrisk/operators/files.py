"""Small files beside tables, on whatever file system their path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The few calls of Hadoop's file system that the tables' small records need."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._configuration = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        location = self._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self._configuration), location

    def exists(self, path: str) -> bool:
        files, location = self._at(path)
        return files.exists(location)

    def names(self, folder: str) -> list[str]:
        """Names of files and folders directly below, sorted; none if there is no such folder."""
        files, location = self._at(folder)
        if not files.exists(location):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(location))

    def read(self, path: str) -> str:
        files, location = self._at(path)
        stream = files.open(location)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str, replace: bool = False) -> None:
        """A whole small file; without ``replace``, an existing one is an error."""
        files, location = self._at(path)
        stream = files.create(location, replace)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        files, location = self._at(path)
        files.delete(location, True)
