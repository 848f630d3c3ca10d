"""Small files in any store that Spark reads, through the file system of their folder."""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import SparkSession


class Folder:
    """A folder named by a path or URL of the session's stores."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self._at("").getFileSystem(self.hadoop)
        self.files.setVerifyChecksum(False)  # other tools write here too
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self.hadoop)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        return sorted(f.getPath().getName() for f in self.files.listStatus(self._at(""))) if self.files.exists(self._at("")) else []

    def exists(self, name: str) -> bool:
        return self.files.exists(self._at(name))

    def read(self, name: str) -> str:
        stream = self.files.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str = "") -> bool:
        """Write a file that isn't there yet; false if it is, of two writers for one of them."""
        if self.exists(name):
            return False
        try:
            stream = self.files.create(self._at(name), False)
        except Exception as e:
            if self.exists(name):
                return False
            raise e
        stream.write(text.encode())
        stream.close()
        return True

    def replace(self, name: str, text: str) -> None:
        """Write a whole file under another name, then rename it over ``name`` in one step."""
        stream = self.files.create(self._at(f".{name}.new"), True)
        stream.write(text.encode())
        stream.close()
        over = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        array = SparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        array[0] = over
        self.context.rename(self._at(f".{name}.new"), self._at(name), array)

    def delete(self, name: str = "") -> None:
        self.files.delete(self._at(name), True)
