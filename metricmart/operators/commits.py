"""SNK-2 / SNK-10: an append-only commit log, the one way that anything here becomes visible.

Tables are written into folders that no reader knows yet. A commit is one small file,
``_log/v<number>.json``, that names them; it is never changed or deleted by a publish. Readers take the highest
number. So a writer that dies between any two steps leaves the old version as it was, and of two writers
that started from one version exactly one gets the next number.

A commit file appears whole or not at all, and only if it is absent: it is written under a name of its own and
then linked (local file system) or renamed without overwrite (``FileContext``; atomic on HDFS and other stores
with an atomic rename). Stores without one aren't suited to hold a log.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer published the version first."""


class Files:
    """Small files on whatever file system a folder lies on (through Hadoop's interface)."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a file whole or not at all; ``Conflict`` if it exists."""
        tmp, target = self.path(f"{name}.{uuid.uuid4().hex}.tmp"), self.path(name)
        stream = self.fs.create(tmp, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self.fs.getUri().getScheme() == "file":
                self._link(tmp, target)
            else:
                self._rename(tmp, target)
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
            raise Conflict(f"{name} was published by another writer; run again on the new version") from None
        finally:
            self.fs.delete(tmp, False)

    def _link(self, tmp, target) -> None:
        local = lambda p: self.jvm.java.io.File(p.toUri().getPath()).toPath()
        self.jvm.java.nio.file.Files.createLink(local(target), local(tmp))

    def _rename(self, tmp, target) -> None:
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.NONE
        qualified = self.fs.makeQualified(tmp), self.fs.makeQualified(target)
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(*qualified, options)

    def age_hours(self, name: str) -> float:
        return (self.jvm.System.currentTimeMillis() - self.fs.getFileStatus(self.path(name)).getModificationTime()) / 3_600_000

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class CommitLog:
    """The versions of one table, or of tables published together."""

    NAME = re.compile(r"^v(\d+)\.json$")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def _file(self, version: int) -> str:
        return f"{self.root}/_log/v{version:06d}.json"

    def versions(self) -> list[int]:
        found = (self.NAME.match(n) for n in self.files.names(f"{self.root}/_log"))
        return sorted(int(m.group(1)) for m in found if m)

    def payload(self, version: int):
        return json.loads(self.files.read(self._file(version)))

    def newest(self, default=None) -> tuple[int, object]:
        """Number and payload of the newest version; 0 and ``default`` before the first."""
        versions = self.versions()
        return (versions[-1], self.payload(versions[-1])) if versions else (0, default)

    def commit(self, base: int, payload) -> int:
        """Publish the version after ``base``; ``Conflict`` if another writer was first."""
        self.files.publish(self._file(base + 1), json.dumps(payload, sort_keys=True))
        return base + 1

    def folder(self, base: int, name: str = "run") -> str:
        """A new folder's name for a writer that started from ``base``."""
        return f"{name}-{base:06d}-{uuid.uuid4().hex}"

    def retire(self, keep: int, named) -> None:
        """Delete all but the newest ``keep`` versions, and the folders that none of them names.

        ``named(payload)`` gives a version's folders. An unnamed folder goes only if its writer started from a version
        older than the newest: it can't publish any more. Those of writers at work stay.
        """
        versions = self.versions()
        if not versions:
            return
        used = {f for v in versions[-keep:] for f in named(self.payload(v))}
        for v in versions[:-keep]:
            self.files.delete(self._file(v))
        for name in self.files.names(self.root):
            m = re.match(r"^[a-z]+-(\d+)-[0-9a-f]{32}$", name)
            if m and name not in used and int(m.group(1)) < versions[-1]:
                self.files.delete(f"{self.root}/{name}")
