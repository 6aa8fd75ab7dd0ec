"""Results kept for keys seen lately."""

from __future__ import annotations

from collections.abc import Callable


class Recent(dict):
    """``make(key)`` for each key, kept for short keys in two generations of ``size``.

    When the newer one is full, it becomes the older one; what is still asked for
    moves back. So memory is bounded and frequent keys stay.
    """

    def __init__(self, make: Callable, size: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.older = make, size, longest, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > self.longest:
                return found
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found
