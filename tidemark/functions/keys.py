"""Keys as they compare: trimmed of white space, lower case, blank as no key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space (Unicode White_Space).
WHITE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def key(col: Column | str) -> Column:
    """White space at both ends removed, lower case; null for null and blank."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.lower(F.btrim(c, F.lit(WHITE))), F.lit(""))


def key_sql(expr: str) -> str:
    """The same key for DuckDB."""
    chars = " || ".join(f"chr({ord(c)})" for c in WHITE)
    return f"nullif(lower(trim({expr}, {chars})), '')"


def finite(c: Column) -> Column:
    """Whether a double is neither null, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
