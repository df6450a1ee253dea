"""Small files of logs, on whatever file system a path belongs to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The file system of a path, whichever it is."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.system = self.path(path).getFileSystem(self._conf)

    def path(self, name: str):
        return self._hadoop.Path(name)

    def glob(self, pattern: str) -> list[str]:
        return [status.getPath().toString() for status in self.system.globStatus(self.path(pattern)) or []]

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, content: str) -> bool:
        """Put a whole new file in place at once; False if there is one of that name already."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self.system.create(self.path(draft), False)
        stream.write(bytearray(content.encode()))
        stream.close()
        context = self._hadoop.FileContext.getFileContext(self.path(name).toUri(), self._conf)
        keep = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(self.path(draft), self.path(name), keep)
            return True
        except Exception as error:
            self.system.delete(self.path(draft), False)
            if "FileAlreadyExists" in str(error):
                return False
            raise

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)
