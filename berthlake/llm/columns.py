"""Input columns whose names an operator uses for itself."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame


def sets_aside(*own: str) -> Callable:
    """For operators on a table: input columns called like one of ``own`` get another name meanwhile, and theirs back after.

    Names are compared as Spark does, without case. An operator that is told to read such a column (as its key, say) reads
    it by the other name. Without a clash nothing is added to the plan.
    """
    def decorate(operator: Callable) -> Callable:
        @wraps(operator)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            taken = {c.lower() for c in [*docs.columns, *own]}
            moved = {}
            for name in docs.columns:
                if name.lower() in {c.lower() for c in own}:
                    free = f"{name}_aside"
                    while free.lower() in taken:
                        free += "_"
                    taken.add(free.lower())
                    moved[name] = free
            if not moved:
                return operator(docs, *args, **kwargs)

            def known_as(value):
                return moved.get(value, value) if isinstance(value, str) else value

            out = operator(
                docs.withColumnsRenamed(moved), *map(known_as, args), **{k: known_as(v) for k, v in kwargs.items()})
            return out.withColumnsRenamed({free: name for name, free in moved.items()})

        return run

    return decorate
