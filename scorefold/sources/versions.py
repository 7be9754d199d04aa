"""Tables that are replaced as a whole, while others read them.

A versioned path is a folder of version folders and a pointer, a small file with the
current one's name.  A writer fills a new folder of its own and then puts a new pointer in
the old one's place, by one rename: readers see the version before or the version after,
a failed write leaves the version before, and two writers never mix.  What was read before
stays readable until `vacuum` deletes old versions.

A path without a pointer is a plain table.  Its first replacement moves it into the folder
as a version; a process that dies between the two renames leaves the old table beside the
path, under `<path>.before-...`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "_current"


class _Files:
    """The file system of a path, as the cluster's Hadoop settings give it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = self.of(path)
        self.fs = self.path.getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)
        self.gateway = spark.sparkContext._gateway
        # a checksum file beside a local pointer could not be switched in the same step
        local = self.fs.getUri().getScheme() == "file"
        self.raw = self.jvm.org.apache.hadoop.fs.FileSystem.getLocal(conf).getRaw() if local else None

    def of(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.of(path))

    def text(self, path: str) -> str:
        stream = (self.raw or self.fs).open(self.of(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def line(self, path: str) -> str:
        """The first line, without its end and a byte-order mark."""
        java, stream = self.jvm.java.io, self.fs.open(self.of(path))
        try:
            return (java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine() or "").removeprefix("\ufeff")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """The whole text under the path at once, in place of what is there."""
        fresh = f"{path}.{uuid.uuid4().hex}"
        stream = (self.raw or self.fs).create(self.of(fresh), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.raw is not None:  # a rename that replaces, as the operating system does it
            if not self.raw.rename(self.of(fresh), self.of(path)):
                raise OSError(f"cannot move {fresh} to {path}")
            return
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self.context.rename(self.fs.makeQualified(self.of(fresh)), self.fs.makeQualified(self.of(path)), options)

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self.of(old), self.of(new)):
            raise OSError(f"cannot move {old} to {new}")

    def delete(self, path: str) -> None:
        self.fs.delete(self.of(path), True)


def first_line(spark: SparkSession, path: str) -> str:
    """A file's first line, of any file system that Spark reads."""
    return _Files(spark, path).line(path)


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: the current version, or the path itself if it has no pointer."""
    files = _Files(spark, path)
    root = path.rstrip("/")
    pointer = f"{root}/{POINTER}"
    return f"{root}/{files.text(pointer).strip()}" if files.exists(pointer) else path


def replace(spark: SparkSession, path: str, write: Callable[[str], object]) -> str:
    """Let `write` fill a new folder, then make it the path's current version; returns that folder.

    `write` may read the path that is replaced.  If it raises, nothing has changed.
    """
    files, root = _Files(spark, path), path.rstrip("/")
    name = f"v-{uuid.uuid4().hex}"
    plain = files.exists(root) and not files.exists(f"{root}/{POINTER}")
    # a plain table's folder must not hold a version before the table itself is one
    place = f"{root}.{name}" if plain else f"{root}/{name}"
    try:
        write(place)
    except BaseException:
        files.delete(place)
        raise
    if plain:
        before = f"{root}.before-{uuid.uuid4().hex}"
        files.move(root, before)
        files.fs.mkdirs(files.path)
        files.move(before, f"{root}/v-{uuid.uuid4().hex}")
        files.move(place, f"{root}/{name}")
    files.put(f"{root}/{POINTER}", name)
    return f"{root}/{name}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The version folders, oldest first."""
    files = _Files(spark, path)
    if not files.exists(f"{path.rstrip('/')}/{POINTER}"):
        return []
    found = [s for s in files.fs.listStatus(files.path) if s.getPath().getName().startswith("v-")]
    return [s.getPath().getName() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().getName()))]


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all versions but the current one and the newest `keep`; returns their names.

    Readers that started on a deleted version fail, and so does a writer that is not
    done with its own: keep what may still be in use.
    """
    files, root = _Files(spark, path), path.rstrip("/")
    now = current(spark, path)
    found = versions(spark, path)
    old = [v for v in found[: max(0, len(found) - keep)] if f"{root}/{v}" != now]
    for v in old:
        files.delete(f"{root}/{v}")
    return old
