"""Small file operations through Hadoop's FileSystem, so any path Spark reads works."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_STATUS = re.compile(r"\w+\{path=(.*?); isDirectory=(?:(true)|false; length=(\d+)); [^{}]*\}(?:,|\}\Z)", re.S)
_SPECIAL = re.compile(r"([\\{}\[\]*?,^])")
#: How many files one call copies, and how many calls run side by side.
BATCH, WORKERS = 64, 8


def _quoted(name: str) -> str:
    """A name as a pattern that only it fits."""
    return _SPECIAL.sub(r"\\\1", name)


class Files:
    """The file system of one root path.

    A call into the JVM takes longer than most of what is asked for there, so whatever grows with files is asked for in bulk.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def tree(self, path: str) -> list[tuple[str, int]]:
        """(path, length) of all files below; one call lists a folder."""
        told_as_text, found, folders = self._jvm.org.apache.commons.lang3.ArrayUtils.toString, [], [self._path(path)]
        while folders:
            listed = self._fs.listStatus(folders.pop())
            told = list(_STATUS.finditer(told_as_text(listed)))
            if len(told) == len(listed):
                found += [(m[1], int(m[3])) for m in told if not m[2]]
                folders += [self._path(m[1]) for m in told if m[2]]
                continue
            for s in listed:  # a file system with a status of its own
                if s.isDirectory():
                    folders.append(s.getPath())
                else:
                    found.append((s.getPath().toString(), s.getLen()))
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def copy(self, source: str, target: str) -> None:
        """Copies a file, replacing the target; file systems may differ."""
        from_path = self._path(source)
        conf = self._fs.getConf()
        if not self._jvm.org.apache.hadoop.fs.FileUtil.copy(from_path.getFileSystem(conf), from_path, self._fs, self._path(target), False, True, conf):
            raise OSError(f"cannot copy {source} to {target}")

    def copy_all(self, source: str, target: str, keys: Iterable[str]) -> None:
        """Copies the files ``keys`` below ``source`` to the same places below ``target``, replacing what is there.

        Files of a folder are copied many a call, and several calls run side by side; a missing file raises.
        """
        copy, paths_of, conf = self._jvm.org.apache.hadoop.fs.FileUtil.copy, self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths, self._fs.getConf()
        there = self._path(source).getFileSystem(conf)

        def run(folder: str, names: list[str]) -> None:
            below = lambda root: root.rstrip("/") + (f"/{folder}" if folder else "")
            pattern = f"{_quoted(below(source))}/{{{','.join(map(_quoted, names))}}}"
            found = paths_of(there.globStatus(self._path(pattern)))
            if len(found) != len(names):
                raise OSError(f"{len(names) - len(found)} of {len(names)} files aren't in {below(source)}")
            self._fs.mkdirs(self._path(below(target)))
            if not copy(there, found, self._fs, self._path(below(target)), False, True, conf):
                raise OSError(f"cannot copy files of {below(source)} to {below(target)}")

        with ThreadPoolExecutor(WORKERS) as pool:
            waiting, running = defaultdict(list), []
            for key in keys:
                folder, _, name = key.rpartition("/")
                waiting[folder].append(name)
                if len(waiting[folder]) == BATCH:
                    running.append(pool.submit(run, folder, waiting.pop(folder)))
            for done in [*running, *(pool.submit(run, *rest) for rest in waiting.items())]:
                done.result()

    def fetch(self, path: str, local: str) -> None:
        """Copies a file to the driver's own disk."""
        self._fs.copyToLocalFile(False, self._path(path), self._path(f"file://{local}"), True)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def modified(self, path: str) -> int:
        return self._fs.getFileStatus(self._path(path)).getModificationTime()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str, overwrite: bool = False) -> None:
        """Writes a file; without ``overwrite`` it fails if the file exists."""
        stream = self._fs.create(self._path(path), overwrite)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
