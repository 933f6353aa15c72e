"""Column expressions with JVM ``String`` semantics, built from Spark built-ins.

``String.split(sep)`` drops trailing empty fields and returns no fields for a
string made only of separators (but ``[""]`` for the empty string); Spark's
``split`` keeps trailing empties. ``String.trim`` strips every char <= U+0020;
Spark's ``trim`` strips spaces only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters String.trim() removes are U+0000..U+0020.
_CTRL_CLASS = "[\\x00-\\x20]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_regex(sep: str) -> str:
    """Java regex matching ``sep`` literally."""
    return "\\Q" + sep + "\\E"


def java_split(c: str | Column, sep: str, regex: bool = False) -> Column:
    """``array<string>`` equal to ``s.split(sep)`` on the JVM (limit 0)."""
    if not sep:
        raise ValueError("separator must not be empty")
    s = _col(c)
    pat = sep if regex else literal_regex(sep)
    if len(sep) == 1 and not regex:
        stripped = F.rtrim(s, F.lit(sep))
    else:  # \z, not $: the latter also matches before a final line terminator
        stripped = F.regexp_replace(s, F.lit(f"(?:{pat})+\\z"), F.lit(""))
    return (F.when(s == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, pat, -1)))


def java_trim(c: str | Column) -> Column:
    """``s.trim()`` on the JVM: strip chars <= U+0020 at both ends."""
    return F.regexp_replace(_col(c), F.lit(f"\\A{_CTRL_CLASS}+|{_CTRL_CLASS}+\\z"), F.lit(""))


# Type names of the column-mapping strings and the value a
# missing cell takes for each.
TYPE_DEFAULTS = {
    "string": ("string", ""),
    "int": ("int", 0),
    "long": ("bigint", 0),
    "float": ("float", 0.0),
    "double": ("double", 0.0),
}


def spark_type(type_name: str) -> str:
    try:
        return TYPE_DEFAULTS[type_name.strip().lower()][0]
    except KeyError:
        raise ValueError(f"unsupported column type {type_name!r}; "
                         f"expected one of {sorted(TYPE_DEFAULTS)}") from None


def strict_cast(c: str | Column, sql_type: str, what: str = "value") -> Column:
    """``cast`` that fails the task on unparseable input whatever the ANSI setting
    (``try_cast``, and ``raise_error`` where it gave null for a non-null input)."""
    s = _col(c)
    t = s.try_cast(sql_type)
    return F.when(s.isNotNull() & t.isNull(),
                  F.raise_error(F.concat(F.lit(f"cannot parse {what} as {sql_type}: "), s.cast("string")))
                  ).otherwise(t)


def strict_get(arr: str | Column, i: int, what: str = "field") -> Column:
    """``arr[i]`` that fails the task when the array is too short (any ANSI setting)."""
    a = _col(arr)
    return F.when(F.size(a) > F.lit(i), F.get(a, i)).otherwise(
        F.raise_error(F.lit(f"missing {what} {i}")).cast("string"))


def utf8_text(c: str | Column, sql_type: str) -> Column:
    """A column as text: binary cells are decoded as UTF-8."""
    return F.decode(_col(c), "UTF-8") if sql_type == "binary" else _col(c)


def typed_or_default(c: str | Column, type_name: str, strict: bool = True) -> Column:
    """Cast text to ``type_name``; a missing (null) value becomes the type default.

    Unparseable text fails the task; ``strict=False`` maps it to the default
    too (``try_cast``).
    """
    sql_type, default = TYPE_DEFAULTS[type_name.strip().lower()]
    s = _col(c)
    cast = strict_cast(s, sql_type) if strict else s.try_cast(sql_type)
    return F.coalesce(cast, F.lit(default).cast(sql_type))
