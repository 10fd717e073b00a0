"""Names to table locations: resolvers are asked in order of priority; the first answer counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from .snapshots import Snapshots


class Resolvers:
    def __init__(self):
        self._known: list[tuple[int, str, Callable[[str], str | None]]] = []

    def register(self, name: str, resolve: Callable[[str], str | None], priority: int = 0) -> None:
        """resolve: from a table's name to its path, or None. Of equal priorities the earlier one is asked first."""
        if any(n == name for _, n, _ in self._known):
            raise ValueError(f"resolver {name} exists")
        self._known = sorted([*self._known, (priority, name, resolve)], key=lambda x: -x[0])

    def path(self, table: str, strict: bool = False) -> str:
        """The first resolver's answer; without one the name itself is a path, or with strict an error."""
        for _, _, resolve in self._known:
            if (found := resolve(table)) is not None:
                return found
        if strict:
            raise KeyError(f"no resolver knows {table}")
        return table

    def open(self, spark: SparkSession, table: str, strict: bool = False) -> Snapshots:
        return Snapshots(spark, self.path(table, strict))
