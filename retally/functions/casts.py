"""Text → integer casts.

``strict`` mirrors the source database: a value that is not a number fails the
job.  The tolerant form yields NULL instead (``try_cast``), which then never
matches a key.  Surrounding blanks are accepted by both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(col: Column | str, strict: bool = True) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if strict:
        # ANSI mode raises on bad text; with ANSI off Spark would silently give
        # NULL, so the failure is made explicit for that case too.
        casted = F.trim(c).try_cast("int")
        return F.when(c.isNull() | casted.isNotNull(), casted).otherwise(
            F.raise_error(F.concat(F.lit("not an integer: "), c.cast("string")))
        )
    return F.trim(c).try_cast("int")
