"""Stop words, read from a file that a caller may replace."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

ENGLISH = str(Path(__file__).with_name("stopwords_en.txt"))


@lru_cache(maxsize=8)
def load(path: str = ENGLISH) -> tuple[str, ...]:
    """The words of a file, in order; lines that begin with # are comments."""
    lines = Path(path).read_text(encoding="utf-8").splitlines()
    return tuple(w for line in lines if not line.startswith("#") for w in line.split())
