"""Wide-column (row key + ``family:qualifier`` cells) tables as typed DataFrames.

The store is modelled as a long *cell table*
``(rowkey string, cf string, qualifier string, value string, version bigint)``
kept in any Spark-readable format. A read keeps only mapped cells (pushed to
the scan as a filter), groups by row key and takes, per mapped column, the
value of the highest version. Row keys with none of the mapped cells are not
returned, as with a column-restricted scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.functions.text import spark_type, strict_cast, typed_or_default, utf8_text

ROW_KEY = ":key"


@dataclass(frozen=True)
class CellColumn:
    source: str      # "cf:qualifier", or ":key" for the row key
    name: str        # output column name
    type: str        # string | int | long | float | double

    @property
    def is_row_key(self) -> bool:
        return self.source.strip() == ROW_KEY

    @property
    def family(self) -> str:
        return self.source.split(":", 1)[0].strip()

    @property
    def qualifier(self) -> str:
        return self.source.split(":", 1)[1].strip()


def _list_body(text: str) -> list[str]:
    body = text.strip()
    if body.startswith("(") and body.endswith(")"):
        body = body[1:-1]
    return [p.strip() for p in body.split(",") if p.strip()]


def parse_column_mapping(store_columns: str, spark_columns: str) -> list[CellColumn]:
    """Pair ``"(cf:q, ...)"`` with ``"(name type, ...)"`` by position."""
    sources = _list_body(store_columns)
    targets = [t.split() for t in _list_body(spark_columns)]
    if len(sources) != len(targets):
        raise ValueError(f"{len(sources)} store columns but {len(targets)} spark columns")
    out = []
    for src, tgt in zip(sources, targets):
        if len(tgt) != 2:
            raise ValueError(f"spark column must be 'name type', got {' '.join(tgt)!r}")
        if ":" not in src:
            raise ValueError(f"store column must be 'family:qualifier' or ':key', got {src!r}")
        spark_type(tgt[1])  # validates the type name
        out.append(CellColumn(src, tgt[0], tgt[1].lower()))
    return out


def read_wide_column(cells: DataFrame, mapping: Sequence[CellColumn] | Sequence[tuple[str, str, str]],
                     rowkey: str = "rowkey", cf: str = "cf", qualifier: str = "qualifier",
                     value: str = "value", version: str = "version",
                     strict: bool = True) -> DataFrame:
    """Typed wide rows from a cell table, one row per row key.

    A mapped cell that is missing takes its type default ("" / 0 / 0.0); a cell or
    row key that does not parse fails the task (``strict=False``: default or null).
    Binary row keys, families, qualifiers and values are read as UTF-8 text.
    """
    types = dict(cells.dtypes)
    cells = cells.select(*[utf8_text(c, types[c]).alias(c) for c in (rowkey, cf, qualifier, value)], version)
    cols = [m if isinstance(m, CellColumn) else CellColumn(*m) for m in mapping]
    data_cols = [c for c in cols if not c.is_row_key]
    src = cells
    if data_cols:
        wanted = reduce(lambda a, b: a | b, [
            (F.col(cf) == F.lit(c.family)) & (F.col(qualifier) == F.lit(c.qualifier)) for c in data_cols])
        src = src.where(wanted)
    order = F.struct(F.col(version), F.col(value))
    aggs = [
        F.max_by(F.col(value), F.when((F.col(cf) == F.lit(c.family)) & (F.col(qualifier) == F.lit(c.qualifier)),
                                      order)).alias(f"_c{i}")
        for i, c in enumerate(data_cols)
    ]
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("_n")]
    grouped = src.groupBy(F.col(rowkey).alias("_rowkey")).agg(*aggs)
    out, k = [], 0
    for c in cols:
        if c.is_row_key:
            t = spark_type(c.type)
            key = F.col("_rowkey")
            out.append((strict_cast(key, t, "row key") if strict else key.try_cast(t)).alias(c.name))
        else:
            out.append(typed_or_default(F.col(f"_c{k}"), c.type, strict=strict).alias(c.name))
            k += 1
    return grouped.select(*out)
