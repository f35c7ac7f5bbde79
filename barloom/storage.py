"""Files through Spark's own file systems: any store that the session can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder of the session's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _at(self, name: str):
        return self._path(self.path(name))

    def exists(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def complete(self, name: str) -> bool:
        """A table was written there to its end."""
        return self.exists(f"{name}/_SUCCESS")

    def names(self, name: str) -> list[str]:
        """What lies in a folder of it, sorted; nothing if there is none."""
        if not self.exists(name):
            return []
        return sorted(x.getPath().getName() for x in self._system.listStatus(self._at(name)))

    def read(self, name: str) -> str:
        stream = self._system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """A new file; an error if it is there."""
        stream = self._system.create(self._at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """A new file that readers see whole or not at all; an error if it is there."""
        if self.exists(name):
            raise FileExistsError(name)
        self._system.delete(self._at(f"{name}.new"), False)
        self.write(f"{name}.new", text)
        if not self._system.rename(self._at(f"{name}.new"), self._at(name)):
            raise FileExistsError(name)

    def delete(self, name: str) -> bool:
        return self._system.delete(self._at(name), True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that every executor sees, deleted when the driver ends: below ``spark.checkpoint.dir``, or in a local session below a folder of this machine."""
    import tempfile
    import uuid

    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {spark.sparkContext.master}")
        found = "file://" + tempfile.mkdtemp(prefix="barloom-")
    folder = Folder(spark, f"{found.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    folder._system.mkdirs(folder._path(folder.root))
    folder._system.deleteOnExit(folder._path(folder.root))
    return folder.root
