"""A bounded memory of computed values, kept per Python worker."""

from __future__ import annotations

from collections.abc import Callable


class Memo(dict):
    """Computes a missing value with ``make`` and keeps it. At ``limit`` entries the table
    becomes the old generation, from which values still in use move back on demand, so
    at most twice ``limit`` entries exist and every lookup stays exact."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self._make, self._limit, self._old = make, limit, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value
