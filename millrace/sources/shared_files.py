"""Small files and folders on any file system Spark can reach, from the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SharedFiles:
    """The file system that holds a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._hadoop = self._jvm.org.apache.hadoop.fs
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._path(folder).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def make_folder(self, path: str) -> None:
        self._files.mkdirs(self._path(path))

    def list(self, folder: str, below: bool = False) -> list[tuple[str, int, int]]:
        """Path relative to ``folder``, bytes and time of change (ms) of each data file,
        those in folders ``below`` too. Names that begin with ``_`` or ``.`` are not data."""
        if not self.exists(folder):
            return []
        root = self._files.makeQualified(self._path(folder)).toUri().getPath().rstrip("/") + "/"
        found, statuses = [], self._files.listFiles(self._path(folder), below)
        while statuses.hasNext():
            status = statuses.next()
            name = status.getPath().toUri().getPath().removeprefix(root)
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                found.append((name, status.getLen(), status.getModificationTime()))
        return sorted(found)

    def names(self, folder: str, depth: int = 1) -> list[str]:
        """Paths relative to ``folder`` of the data files so many levels below it."""
        pattern = "/".join([folder, *["*"] * depth])
        found = self._hadoop.FileUtil.stat2Paths(self._files.globStatus(self._path(pattern)))
        parts = ["/".join(path.toString().rsplit("/", depth)[-depth:]) for path in found or ()]
        return sorted(p for p in parts if not any(x.startswith(("_", ".")) for x in p.split("/")))

    def move(self, old: str, new: str) -> None:
        """Move a file; the folder it goes to is made if it is not there."""
        source, target = self._path(old), self._path(new)
        try:
            if self._files.rename(source, target):
                return
        except Exception:  # some file systems say so like this
            pass
        self.make_folder(new.rpartition("/")[0])
        if not self._files.rename(source, target):
            raise OSError(f"could not move {old} to {new}")

    def remove(self, path: str, below: bool = False) -> None:
        self._files.delete(self._path(path), below)

    def read(self, path: str) -> str:
        stream = self._files.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str, replace: bool = True) -> None:
        """Put a whole small file in its place at once: a reader sees the old text or
        the new one. Without ``replace`` an existing file is an error."""
        new = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        stream = self._files.create(self._path(new), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE if replace else rename.NONE
        target = self._files.makeQualified(self._path(path))
        context = self._hadoop.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(self._files.makeQualified(self._path(new)), target, options)
        except Exception:
            self.remove(new)
            raise
