"""A key's map state as a dictionary that writes back only what changed."""

from __future__ import annotations

from collections.abc import Iterator


#: Entries read one by one before the whole map is.
_SINGLE = 2


class MapView:
    """Read at first use, for one call of a processor; ``write`` passes on the changed entries.

    The first entries asked for are read alone, so a timer that needs one does not read the map.
    """

    def __init__(self, state) -> None:
        self._state = state
        self.begin()

    def begin(self) -> None:
        """Forget what an earlier call (of another key) has read."""
        self._entries: dict[tuple, tuple] = {}
        self._whole = False
        self._asked: set[tuple] = set()
        self._stored: set[tuple] = set()
        self._changed: set[tuple] = set()

    def _all(self) -> dict[tuple, tuple]:
        if not self._whole:
            for k, v in self._state.iterator():
                key = tuple(k)
                if key not in self._asked and key not in self._changed:
                    self._entries[key] = tuple(v)
                self._stored.add(key)
            self._whole = True
        return self._entries

    def _ask(self, key: tuple) -> dict[tuple, tuple]:
        """The entries, in which ``key`` is if it is in the map."""
        if self._whole or key in self._asked or key in self._changed:
            return self._entries
        if len(self._asked) >= _SINGLE:
            return self._all()
        self._asked.add(key)
        value = self._state.getValue(key)
        if value is not None:
            self._entries[key] = tuple(value)
            self._stored.add(key)
        return self._entries

    def __iter__(self) -> Iterator[tuple]:
        return iter(sorted(self._all()))

    def items(self) -> list[tuple[tuple, tuple]]:
        return sorted(self._all().items())

    def get(self, key: tuple, default: tuple | None = None) -> tuple | None:
        return self._ask(key).get(key, default)

    def put(self, key: tuple, value: tuple) -> None:
        self._entries[key] = value
        self._changed.add(key)

    def remove(self, key: tuple) -> None:
        if self._ask(key).pop(key, None) is not None:
            self._changed.add(key)

    def write(self) -> None:
        for key in self._changed:
            if key in self._entries:
                self._state.updateValue(key, self._entries[key])
            elif key in self._stored or (not self._whole and key not in self._asked and self._state.containsKey(key)):
                self._state.removeKey(key)
        self._changed = set()
