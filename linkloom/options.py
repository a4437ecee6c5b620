"""Options of link discovery. They are settled when a plan is built, so switched-off patterns never reach Catalyst."""

from __future__ import annotations

from dataclasses import dataclass, replace

LEAST_THREADS, MOST_THREADS = 2, 8


@dataclass(frozen=True)
class Options:
    parse_javascript: bool = True
    discover_subdomains: bool = True
    threads: int = 2  # a hint for the number of partitions of a scan with one split
    most_inserts: int = 200  # new addresses of one page

    def with_threads(self, n: int) -> Options:
        return replace(self, threads=min(max(n, LEAST_THREADS), MOST_THREADS))

    @classmethod
    def load(cls, stored: dict[str, object]) -> Options:
        """From stored settings; of threads, only the minimum is held to."""
        known = {k: v for k, v in stored.items() if k in cls.__dataclass_fields__}
        found = cls(**known)
        return replace(found, threads=max(found.threads, LEAST_THREADS))

    def store(self) -> dict[str, object]:
        return dict(self.__dict__)
