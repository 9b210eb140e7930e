"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, n, width: int) -> Column:
    """``prefix + printf('%0<width>d', n)`` without the per-row formatter.

    ``lpad`` is codegen'd; it only truncates when the number is wider than ``width`` and
    mishandles the sign, so those rows take the ``format_string`` branch (evaluated only
    when taken).
    """
    n = F.col(n) if isinstance(n, str) else n
    s = n.cast("string")
    fast = F.concat(F.lit(prefix), F.lpad(s, width, "0"))
    slow = F.format_string(prefix.replace("%", "%%") + f"%0{width}d", n)
    return F.when(n.isNull(), F.lit(None).cast("string")) \
            .when((n >= 0) & (F.length(s) <= width), fast).otherwise(slow)
