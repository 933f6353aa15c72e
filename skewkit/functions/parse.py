"""Message parsers: comma-separated words and tab-separated sales records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.functions.text import java_split, java_trim, strict_cast

SALES_FIELDS = 3


def explode_words(df: DataFrame, col: str = "value", sep: str = ",", name: str = "word",
                  keep: Sequence[str] = ()) -> DataFrame:
    """One row per word of ``col`` split on ``sep`` (JVM split rules), plus ``keep`` columns."""
    return df.select(*keep, F.explode(java_split(col, sep)).alias(name))


def parse_sales(df: DataFrame, col: str = "value", strict: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``id \\t name \\t money`` records into ``(id, name, money double)``.

    A record is kept when it has exactly three fields (after JVM split, so a
    trailing tab does not count), its trimmed id is not ``"0"`` (the documented
    sentinel, so a real id ``0`` is dropped too) and its money parses. With
    ``strict=True`` unparseable money raises instead of dropping the row.
    Money text parses as the JVM's ``Double.parseDouble`` does (Spark's cast
    accepts the same forms: ``1.5d``, ``0x1p3``, ``+2.5``, ``NaN``, ``Infinity``).
    """
    staged = df.select(*keep, java_split(col, "\t").alias("_f"))
    money_txt = java_trim(F.get(F.col("_f"), 2))
    record = F.struct(
        java_trim(F.get(F.col("_f"), 0)).alias("id"),
        java_trim(F.get(F.col("_f"), 1)).alias("name"),
        (strict_cast(money_txt, "double", "money") if strict else money_txt.try_cast("double")).alias("money"),
    )
    parsed = staged.select(*keep, F.when(F.size("_f") == F.lit(SALES_FIELDS), record).alias("_r"))
    # Keep/drop as a 0-or-1-row generator over the parsed record: a Filter here
    # would be pushed below the parse and re-evaluate the split per predicate.
    keep_rec = F.filter(F.array("_r"), lambda r: r.isNotNull() & (r["id"] != F.lit("0")) & r["money"].isNotNull())
    return parsed.select(*keep, F.inline(keep_rec))
