"""Small helpers shared by the column builders."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(x, literal: bool = False) -> Column:
    """Column from a Column, a number, a date, or a name.

    Strings are column names unless ``literal`` is set; a string literal
    shaped like ``2040Q1`` is parsed as a quarter.
    """
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        if not literal:
            return F.col(x)
        import re
        if re.fullmatch(r"\s*\d{4}[Qq][1-4]\s*", x):
            y, q = int(x.strip()[:4]), int(x.strip()[5])
            return F.lit(_dt.date(y, 3 * q - 2, 1))
        return F.lit(x)
    return F.lit(x)
