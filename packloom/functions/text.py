"""White space as the chunker defines it, for Spark expressions and for regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space when a text is stripped or split.
SPACES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = "".join(map(chr, SPACES))
JAVA_CLASS = "".join(f"\\x{{{o:X}}}" for o in SPACES)


def strip(text: Column | str) -> Column:
    """``text`` without white space at either end."""
    return F.btrim(text if isinstance(text, Column) else F.col(text), F.lit(WS))


def not_blank(text: Column | str) -> Column:
    """Whether ``text`` has anything but white space; null counts as blank."""
    return F.coalesce(F.length(strip(text)) > 0, F.lit(False))
