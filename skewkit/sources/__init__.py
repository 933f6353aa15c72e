"""Sources: delimited text, ORC, wide-column cell tables and message streams."""

from skewkit.sources.delimited import parse_delimited, scan_delimited, scan_orc  # noqa: F401
from skewkit.sources.wide_column import CellColumn, parse_column_mapping, read_wide_column  # noqa: F401
