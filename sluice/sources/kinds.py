"""Named kinds of things that can be plugged in."""

from __future__ import annotations

from collections.abc import Callable


class UnknownKind(ValueError):
    """A kind nobody has registered; the message lists those that are."""


class Registry:
    """Case-insensitive names."""

    def __init__(self, what: str):
        self.what, self._known = what, {}

    def register(self, name: str, make: Callable) -> None:
        self._known[name.lower()] = make

    def get(self, name: str) -> Callable:
        if name.lower() not in self._known:
            raise UnknownKind(f"unknown {self.what} {name!r}; known: {', '.join(sorted(self._known))}")
        return self._known[name.lower()]
