"""Text expressions with Python ``str`` semantics, built from Spark functions.

Spark's ``trim`` removes only U+0020, while the delivery tools strip with
Python's ``str.strip()``, which removes every character for which
``str.isspace()`` is true.  The character class below is that set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.constants import PY_SPACE_CLASS

_STRIP_PATTERN = rf"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+\z"
_BLANK_PATTERN = rf"^{PY_SPACE_CLASS}*\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()`` as a native expression."""
    return F.regexp_replace(_col(c), _STRIP_PATTERN, "")


def is_blank(c: Column | str) -> Column:
    """True when ``c.strip() == ''`` (null stays null)."""
    return _col(c).rlike(_BLANK_PATTERN)


def is_empty_value(c: Column, dtype) -> Column:
    """The delivery tools' emptiness test ``v is None or v == ''``.

    Only null and the empty *string* are empty; ``' '``, ``0``, ``false``,
    ``[]`` and ``{}`` are not.
    """
    from pyspark.sql.types import StringType

    if isinstance(dtype, StringType):
        return c.isNull() | (c == F.lit(""))
    return c.isNull()
