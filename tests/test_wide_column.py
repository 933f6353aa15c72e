import pytest

from conftest import rows
from skewkit.sources.wide_column import CellColumn, parse_column_mapping, read_wide_column

CELLS = [
    # rowkey, cf, qualifier, value, version
    ("1", "d", "name", "ann", 1),
    ("1", "d", "money", "1.5", 1),
    ("1", "d", "money", "2.5", 3),       # newer version wins
    ("1", "d", "money", "9.9", 2),
    ("2", "d", "name", "bob", 1),        # money missing -> default 0.0
    ("3", "o", "offset", "42", 1),       # no mapped cell -> row not returned
    ("4", "d", "money", "7", 1),         # name missing -> ""
    ("4", "d", "qty", "3", 1),
    ("5", "d", "qty", "x", 1),           # unparseable -> default in non-strict mode
    ("5", "d", "name", "eve", 1),
]


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(CELLS, "rowkey string, cf string, qualifier string, value string, version long")


def test_parse_column_mapping():
    m = parse_column_mapping("(:key, d:name, d:money)", "(id long, name string, money double)")
    assert m == [CellColumn(":key", "id", "long"), CellColumn("d:name", "name", "string"),
                 CellColumn("d:money", "money", "double")]
    assert m[0].is_row_key and not m[1].is_row_key
    with pytest.raises(ValueError):
        parse_column_mapping("(:key, d:name)", "(id long)")
    with pytest.raises(ValueError):
        parse_column_mapping("(:key)", "(id decimal)")


def test_read_wide_column(cells):
    m = parse_column_mapping("(:key, d:name, d:money, d:qty)", "(id long, name string, money double, qty int)")
    df = read_wide_column(cells, m, strict=False)
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("money", "double"), ("qty", "int")]
    assert rows(df) == [(1, "ann", 2.5, 0), (2, "bob", 0.0, 0), (4, "", 7.0, 3), (5, "eve", 0.0, 0)]


def test_read_wide_column_float_and_key_only(cells):
    df = read_wide_column(cells, [(":key", "id", "string"), ("d:money", "m", "float")])
    assert dict(df.dtypes)["m"] == "float"
    assert rows(df) == [("1", 2.5), ("4", 7.0)]
    assert rows(read_wide_column(cells, [(":key", "id", "int")])) == [(1,), (2,), (3,), (4,), (5,)]


def test_read_wide_column_strict_raises(cells):
    with pytest.raises(Exception):
        read_wide_column(cells, [(":key", "id", "string"), ("d:qty", "q", "int")]).collect()


def test_binary_cells_are_utf8_text(spark, cells):
    from pyspark.sql import functions as F
    m = [(":key", "id", "long"), ("d:name", "name", "string"), ("d:money", "m", "double")]
    text = cells.unionByName(spark.createDataFrame([("6", "d", "name", "zoë", 1)], cells.schema))
    raw = text.withColumns({c: F.encode(c, "UTF-8") for c in ("rowkey", "cf", "qualifier", "value")})
    assert rows(read_wide_column(raw, m)) == rows(read_wide_column(text, m))
    assert (6, "zoë", 0.0) in rows(read_wide_column(raw, m))
    bad = spark.createDataFrame([("x", "d", "name", "ann", 1)], cells.schema)
    with pytest.raises(Exception):
        read_wide_column(bad, m).collect()
