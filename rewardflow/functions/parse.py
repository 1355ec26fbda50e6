"""Typed parses of text columns. Failures give NULL, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT

# optional sign and digits, surrounding spaces allowed
_INT_TEXT = r"^ *[+-]?[0-9]+ *$"
_NUM_TEXT = r"^ *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,4})? *$"


def parse_int(c: Column | str) -> Column:
    """Integer text -> int; '0742' -> 742; anything else -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(_INT_TEXT), F.trim(c).try_cast("int"))


def parse_amount(c: Column | str) -> Column:
    """Decimal text, with or without an exponent -> decimal(28,10); anything else,
    and what does not fit, -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(_NUM_TEXT), F.trim(c).try_cast(AMOUNT))
