"""Small files on any file system that Spark reads."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def write_atomic(path: str, text: str) -> None:
    """Put a local file in its place by a rename."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.tmp", "w", encoding="utf-8", newline="\n") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f"{path}.tmp", path)


class Files:
    """Whole files and folders by path, in UTF-8."""

    def __init__(self, spark: SparkSession):
        self._sc = spark.sparkContext
        self._jvm, self._conf = self._sc._jvm, self._sc._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def sizes(self, path: str) -> dict[str, int]:
        """Name to bytes of what lies in a folder; nothing if there is no such folder."""
        fs, p = self._at(path)
        return {s.getPath().getName(): s.getLen() for s in fs.listStatus(p)} if fs.exists(p) else {}

    def read(self, path: str) -> str | None:
        """A file's text, None if there is none."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> bool:
        """Give a file a name that no file has; False if one has it already."""
        fs, p = self._at(source)
        to = self._at(target)[1]
        return not fs.exists(to) and fs.rename(p, to)

    def replace(self, path: str, text: str) -> None:
        """Put a text in a file's place, so that readers see the old one or the new one."""
        fs, p = self._at(path)
        if fs.getUri().getScheme() == "file":
            return write_atomic(p.toUri().getPath(), text)
        self.write(f"{path}.tmp", text)
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._sc._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf).rename(self._at(f"{path}.tmp")[1], p, how)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
