"""Arguments that name some of a fixed set of words."""

from __future__ import annotations

from collections.abc import Iterable

from lamina.errors import InvalidParameterError


class Choice:
    """A set of words a caller may pick from, in its order; ``what`` is one of them."""

    def __init__(self, what: str, words: Iterable[str]):
        self.what, self.words = what, tuple(words)

    def picked(self, asked: str | Iterable[str] | None) -> tuple[str, ...]:
        """The asked words in the set's own order, all of them where nothing is asked for."""
        if asked is None:
            return self.words
        wanted = dict.fromkeys([asked] if isinstance(asked, str) else asked)
        strange = ", ".join(sorted(str(word) for word in wanted if word not in self.words))
        if strange:
            raise InvalidParameterError(
                f"There is no {self.what} called {strange}, only {', '.join(self.words)}."
            )
        return tuple(word for word in self.words if word in wanted)
