"""Small text files in the shared folder, by Hadoop's file systems, from the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SharedFiles:
    def __init__(self, spark: SparkSession) -> None:
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway

    def _at(self, path: str):
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        """What is in ``folder``, sorted; nothing if it is missing."""
        place, fs = self._at(folder)
        if not fs.exists(place):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(place))

    def size(self, path: str) -> int:
        """Bytes of all files below ``path``."""
        place, fs = self._at(path)
        return fs.getContentSummary(place).getLength()

    def read(self, path: str) -> str:
        place, fs = self._at(path)
        stream = fs.open(place)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Puts the whole file there at once, unless there is one already; says whether it did."""
        folder, _, name = path.rpartition("/")
        draft, fs = self._at(f"{folder}/.{name}-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        place, _ = self._at(path)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf)
        plain = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(place), plain)
        except Exception as error:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" not in str(error):
                raise
            return False
        return True

    def remove(self, path: str) -> None:
        place, fs = self._at(path)
        fs.delete(place, True)
