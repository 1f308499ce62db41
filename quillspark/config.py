"""Settings, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Settings:
    """Of a refresh: first year of the archive (None: three calendar years back), kinds of documents, chunk sizes, vectors."""

    monitored: list[str]
    start_year: int | None = None
    kinds: list[str] = field(default_factory=lambda: ["Corrected", "Raw"])
    expected_sections: list[str] = field(default_factory=list)
    chunk_whole: int = 1000
    chunk_target: int = 500
    chunk_tail: int = 300
    vector_width: int = 3072
    zone: str = "America/Toronto"

    def __post_init__(self) -> None:
        if not self.monitored:
            raise ValueError("no monitored institution")
        if self.start_year is not None and not 2000 <= self.start_year <= date.today().year:
            raise ValueError("start_year lies outside 2000 to this year")
        if not 0 < self.chunk_tail <= self.chunk_target <= self.chunk_whole:
            raise ValueError("chunk sizes must satisfy tail <= target <= whole")
        if self.vector_width < 1:
            raise ValueError("vector_width must be positive")
