"""Small files of a shared folder, written whole or not at all."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class SharedFolder:
    """Files below ``root`` on any file system that Spark can write to.

    ``create`` is what commits rest on: of several writers of one name just one succeeds, and no reader sees
    a part of a file. It writes under another name first and takes the name by a rename that does not overwrite;
    on a local disk, where a rename would, by a hard link.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        path = self._path("")
        self._fs = path.getFileSystem(self._conf)
        self._local = self._fs.getUri().getScheme() == "file"

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self, name: str, text: str) -> bool:
        """Whether the file was made; false if the name is taken."""
        target = self._path(name)
        if self._fs.exists(target):
            return False
        part = self._path(f"{name}.{uuid.uuid4().hex}.part")
        stream = self._fs.create(part, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self._local:
                os.link(part.toUri().getPath(), target.toUri().getPath())
                self._fs.delete(part, False)
                return True
            hadoop = self._jvm.org.apache.hadoop.fs
            kind = self._gateway.new_array(hadoop.Options.Rename, 0)  # no flag: do not overwrite
            hadoop.FileContext.getFileContext(target.toUri(), self._conf).rename(part, target, kind)
            return True
        except FileExistsError:
            taken = True
        except Exception:
            taken = self._fs.exists(target)
            if not taken:
                raise
        self._fs.delete(part, False)
        return not taken

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def entries(self, folder: str) -> dict[str, int]:
        """Names in a folder, without unfinished files, and when they were last changed, in milliseconds."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return {}
        found = {f.getPath().getName(): f.getModificationTime() for f in self._fs.listStatus(path)}
        return {name: at for name, at in found.items() if not name.endswith((".part", ".crc"))}

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
