"""Memory of Python workers, which Spark uses again and again: what a task has freed goes back to the system when it ends."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def free_memory() -> None:
    """Gives what is free back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


#: The cached factories of this worker, by their name.
_factories: dict[str, Callable] = {}
#: Those that the running task has asked.
_asked: set[str] = set()


def worker_cache(make):
    """One object a worker and arguments. Asking for another one frees it: a reused worker never holds what an earlier stage kept."""
    held: dict = {}

    @functools.wraps(make)
    def get(*args):
        if args not in held:
            for other in _factories.values():
                other.held.clear()
            free_memory()
            held[args] = make(*args)
            free_memory()
        _asked.add(make.__qualname__)
        return held[args]

    get.held = held
    _factories[make.__qualname__] = get
    return get


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` that frees memory at each task's end, and what earlier stages cached and this one does
    not ask for: ``df.transform(mapped, run, schema)``."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _asked.clear()
        try:
            yield from run(batches)
        finally:
            for name, factory in _factories.items():
                if name not in _asked:
                    factory.held.clear()
            free_memory()

    return df.mapInArrow(lean, schema)
