"""Registration of queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    """Queries and check texts by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.checks: dict[str, str] = {}

    def __call__(self, check: str | None = None):
        def register(fn):
            self.queries[fn.__name__] = fn
            if check:
                self.checks[fn.__name__] = check
            return fn

        return register
