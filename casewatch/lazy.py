"""Work on several tables: frames built on first use, and actions that run side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cache
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


AT_ONCE = 4


def side_by_side(names: Iterable[str], work: Callable[[str], object], at_once: int = AT_ONCE) -> dict:
    """work(name) for each name, a few at once: one table's jobs seldom fill a cluster."""
    names, session = list(names), SparkSession.getActiveSession()
    target = inheritable_thread_target(session)(work) if session else work
    with ThreadPool(at_once) as pool:
        return dict(zip(names, pool.map(target, names, chunksize=1)))


class LazyTables(Mapping):
    """A read-only mapping of table name to DataFrame that builds each on first use."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]):
        self._names = list(names)
        self._build = cache(build)

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._names:
            raise KeyError(table)
        return self._build(table)

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def __contains__(self, table: object) -> bool:
        return table in self._names
