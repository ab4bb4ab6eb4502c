"""What callers of the read-out queries may ask for: names, bounds in time, and pages."""

from __future__ import annotations

from collections.abc import Collection
from datetime import UTC, date, datetime

# Series that are served, and page sizes of a paging caller.
DEFAULT_SYMBOLS = ("BTCUSDC", "ETHUSDC", "SOLUSDC")
DEFAULT_INTERVALS = ("1s", "1m", "15m", "1h")
DEFAULT_PAGE = 100
LARGEST_PAGE = 500


class ParameterError(ValueError):
    """A parameter that no query can be built from."""

    def __init__(self, name: str, problem: str) -> None:
        super().__init__(f"parameter {name!r}: {problem}")
        self.name = name


def one_of(allowed: Collection[str], **given: str | None) -> str:
    """The value of one keyword, which must be among ``allowed``: ``one_of(SYMBOLS, symbol=value)``."""
    ((name, value),) = given.items()
    if value in allowed:
        return value
    shown = "is needed" if value in (None, "") else f"{value!r} is not served"
    raise ParameterError(name, f"{shown}; known are {', '.join(sorted(allowed))}")


def page_limit(asked: int | str | None = None) -> int:
    """Rows of a page for callers that page: ``DEFAULT_PAGE`` if nothing is asked, ``LARGEST_PAGE`` at most."""
    text = str(DEFAULT_PAGE if asked in (None, "") else asked).strip()
    if text.isdecimal() and int(text) in range(1, LARGEST_PAGE + 1):
        return int(text)
    raise ParameterError("limit", f"{text!r} is not a whole number from 1 to {LARGEST_PAGE}")


def instant(name: str, text: str | None) -> datetime | None:
    """UTC time of an ISO date (its midnight) or timestamp, to the microsecond; without a zone it is UTC."""
    parsed = _iso(datetime, name, text)
    if parsed is None:
        return None
    return parsed.astimezone(UTC) if parsed.tzinfo else parsed.replace(tzinfo=UTC)


def calendar_day(name: str, text: str | None) -> date | None:
    return _iso(date, name, text)


def _iso(kind: type, name: str, text: str | None):
    try:
        return kind.fromisoformat(text) if text else None
    except ValueError:
        raise ParameterError(name, f"{text!r} is no ISO {kind.__name__}") from None
