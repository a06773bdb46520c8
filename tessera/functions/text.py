"""Text helpers: splitting, tokenizing, quote stripping and number parsing.

All are native Spark expressions: Catalyst prunes columns around them; those
with lambdas are interpreted, the others take part in code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_fields(col, delimiter: str) -> Column:
    """Split a line on a literal delimiter; every field is kept (``a,,b,``
    gives four fields)."""
    import re

    return F.split(_c(col), re.escape(delimiter))


def regex_tokenize(col, pattern: str = "\\s+", to_lowercase: bool = True,
                   min_token_length: int = 1) -> Column:
    """MLlib ``RegexTokenizer`` (gaps mode) as an expression: optional
    lower-casing, split on ``pattern``, drop tokens shorter than the minimum
    (so empty tokens vanish and later positions shift left)."""
    src = F.lower(_c(col)) if to_lowercase else _c(col)
    return F.filter(F.split(src, pattern), lambda t: F.length(t) >= min_token_length)


def strip_quotes(col, quote: str = '"') -> Column:
    """Remove every quote character."""
    import re

    return F.regexp_replace(_c(col), re.escape(quote), "")


def parse_doubles(col, strict: bool = True) -> Column:
    """Array of strings to array of doubles.

    ``strict`` keeps the fail-on-malformed behaviour (ANSI cast raises);
    otherwise malformed tokens become null via ``try_cast``.
    """
    if strict:
        return F.transform(_c(col), lambda t: t.cast("double"))
    return F.transform(_c(col), lambda t: t.try_cast("double"))


def truncate_to_int(col) -> Column:
    """Decimal text or number to int, truncating toward zero
    (``"1998.9"`` -> 1998, ``"-1.7"`` -> -1) via float, as ``toFloat.toInt``."""
    return _c(col).cast("float").cast("int")
