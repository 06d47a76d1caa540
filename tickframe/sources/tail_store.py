"""Tails of an appended table, stored beside it and moved on with every append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.operators.tails import TAIL_COLUMNS, advance, tail_schema, tails_of
from tickframe.session import folder_size, path_exists, remove_folder
from tickframe.sources.ledger import Ledger


class TailStore:
    """Versions of the tails: a full one, then one for the touched symbols of every append, then a full one again.

    Every version's entry in the ledger names the size of the table it belongs to. A table of another size has been
    written by somebody else, or by a run that ended before its entry: its tails are then made anew from its rows. The
    entry also carries a bookmark, so what has been read and what has been kept of it are committed together.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: str,
        n: int,
        price: str = "average_price",
        order: Sequence[str] = ("collection_time",),
        symbol: str = "symbol",
        full_every: int = 10,
    ):
        self.spark, self.table, self.path = spark, table.rstrip("/"), f"{table.rstrip('/')}_tails"
        self.n, self.price, self.order, self.symbol, self.full_every = n, price, tuple(order), symbol, full_every
        self.ledger = Ledger(spark, f"{self.path}/_entries")

    def bookmark(self, default=None):
        last = self.ledger.last()
        return last[1].get("bookmark", default) if last else default

    def _shape(self) -> dict:
        files, size = folder_size(self.spark, self.table) if path_exists(self.spark, self.table) else (0, 0)
        return {"files": files, "bytes": size, "rows": self.n, "columns": [self.symbol, *self.order, self.price]}

    def _version(self, number: int) -> str:
        return f"{self.path}/version={number}"

    def _current(self) -> tuple[int, list[int]]:
        """The last version's number, and the versions to read from its full one on; none when they don't fit the table."""
        numbers = self.ledger.numbers()
        if not numbers:
            return -1, []
        shape, wanted = self._shape(), []
        for number in reversed(numbers):
            entry = self.ledger.read(number)
            if not wanted and {k: entry.get(k) for k in shape} != shape:
                return numbers[-1], []
            wanted.insert(0, number)
            if entry["full"]:
                return numbers[-1], wanted
        return numbers[-1], []

    def load(self, history: DataFrame) -> DataFrame:
        """Tails that belong to the table as it is; ``history`` is read only where stored ones don't fit."""
        _, versions = self._current()
        if not versions:
            return tails_of(history, self.n, self.price, self.order, self.symbol)
        return self._stored(versions, tail_schema(history, self.price, self.order, self.symbol))

    def _stored(self, versions: list[int], schema: str) -> DataFrame:
        reader = self.spark.read.schema(f"{schema}, version bigint").option("basePath", self.path)
        stored = reader.parquet(*[self._version(v) for v in versions])
        if len(versions) == 1:
            return stored.drop("version")
        newest = F.max_by(F.struct(*TAIL_COLUMNS), "version").alias("_tail")
        return stored.groupBy(self.symbol).agg(newest).select(self.symbol, "_tail.*")

    def commit(self, tails: DataFrame, added: DataFrame, was_stored: bool, bookmark=None) -> int:
        """The version after ``added`` rows were appended to the table; returns its number.

        ``tails`` are those from before the append, as ``load`` gave them: stored ones get a version of the touched
        symbols, or a full one every ``full_every`` versions; others are stored whole.
        """
        last, versions = self.ledger.last(), []
        number = last[0] + 1 if last else 0
        new = tails_of(added, self.n, self.price, self.order, self.symbol)
        moved = advance(tails, new, self.n, self.symbol)
        since_full = 0
        if was_stored:
            for since_full, old in enumerate(reversed(self.ledger.numbers())):
                versions.insert(0, old)
                if self.ledger.read(old)["full"]:
                    break
        full = not was_stored or since_full + 1 >= self.full_every
        if full:
            moved = tails.join(moved.select(self.symbol), self.symbol, "left_anti").unionByName(moved)
        moved.write.mode("overwrite").parquet(self._version(number))
        self.ledger.commit(number, {**self._shape(), "full": full, "bookmark": bookmark})
        if full:
            # Readers of the version before may still be at work, so what went before that one goes.
            for old in [v for v in self.ledger.numbers() if v < (versions[0] if versions else number)]:
                remove_folder(self.spark, self._version(old), inside=self.path)
        return number

    def is_stored(self) -> bool:
        return bool(self._current()[1])
