"""Typed reads of delimited text lines (no header), and ORC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewkit.functions.text import java_split, strict_cast, strict_get


def parse_delimited(lines: DataFrame, names: Sequence[str], sep: str = " ", col: str = "value",
                    types: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """Fields ``0..len(names)-1`` of each line, split with JVM rules; extra fields ignored.

    A line with too few fields fails the task, as does an unparseable typed
    field; with ``strict=False`` the line is dropped and the field is null.
    ``types`` casts each field (default: string).
    """
    names = list(names)
    types = list(types or ["string"] * len(names))
    if len(types) != len(names):
        raise ValueError("names and types must have the same length")
    fields = lines.select(java_split(col, sep).alias("_f"))
    if strict:
        cols = [strict_cast(strict_get("_f", i, "field"), t, n).alias(n) for i, (n, t) in enumerate(zip(names, types))]
        return fields.select(*cols)
    record = F.struct(*[F.get(F.col("_f"), i).try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))])
    parsed = fields.select(F.when(F.size("_f") >= F.lit(len(names)), record).alias("_r"))
    # 0-or-1-row generator instead of a Filter, so the split runs once per line
    return parsed.select(F.inline(F.filter(F.array("_r"), lambda r: r.isNotNull())))


def scan_delimited(spark: SparkSession, path: str | Sequence[str], names: Sequence[str],
                   sep: str = " ", types: Sequence[str] | None = None,
                   strict: bool = True) -> DataFrame:
    """Read text files (one record per line) into typed columns.

    Splittable text is read in parallel by ``spark.read.text``; each task
    splits its own lines, so nothing passes through the driver.
    """
    return parse_delimited(spark.read.text(path), names, sep=sep, types=types, strict=strict)


def scan_orc(spark: SparkSession, path: str | Sequence[str],
             schema: T.StructType | str | None = None) -> DataFrame:
    """ORC read; with ``schema`` the read is typed (no inference) and projected to it."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.orc(path)
    if schema is None:
        return df
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in st.fields])
