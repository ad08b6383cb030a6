"""Column names and numbers as SQL text.

Wide tables need the same expression for dozens of columns. One piece of SQL text per
column costs one call to the JVM; the same expression put together in Python costs many.
"""

from __future__ import annotations

import math


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number(value: float) -> str:
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value!r}')"
    return repr(value)
