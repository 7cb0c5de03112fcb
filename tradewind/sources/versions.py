"""Versions of a stored model, of which one is current; readers move to a new one all at once."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Versions:
    """Numbered pointers below ``root``/published, each naming the folders of one version.

    A pointer is written aside and renamed to its number without overwriting: it is there whole or
    not at all, and of two writers of one number the second fails. The highest number is current.
    What a pointer names is never changed afterwards.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def new_folder(self) -> str:
        return f"{self.root}/versions/{uuid.uuid4().hex}"

    def numbers(self) -> list[int]:
        fs, folder = self._fs(), self._path("published")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def current(self) -> dict[str, str] | None:
        """The folders of the current version by role, or None before the first."""
        numbers = self.numbers()
        if not numbers:
            return None
        folders = self._read(numbers[-1])
        return {role: f"{self.root}/{folder}" if folder else self.root for role, folder in folders.items()}

    def _read(self, number: int) -> dict[str, str]:
        stream = self._fs().open(self._path(f"published/{number:010d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, folders: dict[str, str]) -> int:
        """Make the folders, all below ``root``, the current version; gives its number."""
        inside = {}
        for role, folder in folders.items():
            if folder != self.root and not folder.startswith(f"{self.root}/"):
                raise ValueError(f"{folder} is not below {self.root}")
            inside[role] = folder[len(self.root) + 1 :]
        numbers = self.numbers()
        number = numbers[-1] + 1 if numbers else 1
        aside = self._path(f"published/.{uuid.uuid4().hex}")
        stream = self._fs().create(aside, False)
        stream.write(bytearray(json.dumps(inside).encode()))
        stream.close()
        context = self._hadoop.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(self._hadoop, "Options$Rename")
        no_overwrite = self.spark.sparkContext._gateway.new_array(rename, 0)
        qualified = self._fs().makeQualified
        context.rename(qualified(aside), qualified(self._path(f"published/{number:010d}")), no_overwrite)
        return number

    def retire(self, keep: int = 2) -> list[str]:
        """Delete the folders of all but the last ``keep`` versions that no kept version names.

        Meant for when no reader is still on an older version.
        """
        fs = self._fs()
        used = {number: set(self._read(number).values()) for number in self.numbers()}
        kept = sorted(used)[-keep:] if keep > 0 else []
        needed = set().union(*[used[n] for n in kept]) if kept else set()
        gone = []
        for number in sorted(set(used) - set(kept)):
            fs.delete(self._path(f"published/{number:010d}"), False)
            for folder in sorted(used[number] - needed):
                if folder.startswith("versions/") and fs.delete(self._path(folder), True):
                    gone.append(folder)
        return gone
