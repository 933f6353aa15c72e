"""Scalar column helpers and message parsers."""

from skewkit.functions.parse import explode_words, parse_sales  # noqa: F401
from skewkit.functions.text import java_split, java_trim, typed_or_default  # noqa: F401
