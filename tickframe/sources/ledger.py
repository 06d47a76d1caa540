"""Numbered entries in a folder: what has been committed, readable by the next run."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Ledger:
    """One small JSON file per entry. An entry appears whole or not at all, and a number is given out once.

    Entries are read by name order, so a run that looks at what came after its own bookmark opens only those.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._gateway = spark.sparkContext._gateway
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _system(self):
        return self._at().getFileSystem(self._conf)

    def numbers(self, after: int = -1) -> list[int]:
        system, folder = self._system(), self._at()
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        found = (int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())
        return sorted(n for n in found if n > after)

    def read(self, number: int) -> dict:
        stream = self._system().open(self._at(f"{number:012}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def _no_options(self):
        return self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    def commit(self, number: int, entry: dict) -> None:
        """Add an entry. A second one under the same number is refused, so of two runs that race only one goes on."""
        draft, target = self._at(f".{uuid.uuid4().hex}"), self._at(f"{number:012}.json")
        stream = self._system().create(draft, False)
        try:
            stream.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(draft, target, self._no_options())
        except Exception as error:
            self._system().delete(draft, False)
            raise FileExistsError(f"entry {number} of {self.path} is there already") from error
