"""Constants of the download analytics, and their invariants."""

from __future__ import annotations

from dataclasses import dataclass

# Name prefixes of the three namespaces, in order of preference.
PREFIXES = {"cran": "r-cran-", "bioc": "r-bioc-", "other": "r-other-"}
DEFAULT_NAMESPACE = "other"
PREFERRED_ARCH = "amd64"


@dataclass(frozen=True)
class Windows:
    """Days of the rolling windows and of the refresh."""

    summary: tuple[int, int, int] = (30, 90, 365)
    recent: int = 400
    active: int = 180
    revision: int = 90

    def __post_init__(self) -> None:
        if self.recent <= self.active + self.revision:
            raise ValueError("the recent window must outlast the active and revision windows together")


@dataclass(frozen=True)
class Floors:
    """Least sizes of the identity ledgers of a live run."""

    cran: int = 15_000
    bioc: int = 1_500


@dataclass(frozen=True)
class Channel:
    """A source archive."""

    key: str
    ref: str
    enabled: bool = True


WINDOWS = Windows()
FLOORS = Floors()


def enabled(channels: list[Channel]) -> list[Channel]:
    return [c for c in channels if c.enabled]


def channel_by_key(channels: list[Channel], key: str) -> Channel | None:
    return next((c for c in channels if c.key == key), None)


def flag(value: str | None) -> bool:
    """Whether an environment switch is on."""
    return (value or "").strip().lower() in ("1", "true", "yes")


def pool_size(value: str | None, fallback: int) -> int:
    """A positive number of connections from text, or the fallback."""
    try:
        n = int(value or "")
    except ValueError:
        return fallback
    return n if n > 0 else fallback
