"""The set of domain tables an operator reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


class Core:
    """Named tables, each built on first use and then kept as a lazy DataFrame.

    Reports ask for ``core["visit"]`` and never care whether the table is a Parquet
    directory, a projection of other tables or a small frame made by a test.
    """

    def __init__(
        self,
        spark: SparkSession,
        makers: Mapping[str, Callable[[], DataFrame] | DataFrame],
        largest: Callable[[str], int | None] | None = None,
    ):
        self.spark = spark
        self._largest = largest
        self._makers = dict(makers)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            maker = self._makers[name]
            self._built[name] = maker if isinstance(maker, DataFrame) else maker()
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in self._makers

    def names(self) -> list[str]:
        return list(self._makers)

    def largest(self, name: str) -> int | None:
        """The largest number in use among a table's keys, where it is kept with the table."""
        return self._largest(name) if self._largest else None

    def replaced(self, **tables: DataFrame) -> Core:
        """The same tables with some of them swapped for others."""
        kept = (lambda name: None if name in tables else self.largest(name)) if self._largest else None
        return Core(self.spark, {**self._makers, **self._built, **tables}, kept)
