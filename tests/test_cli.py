import os

from conftest import SITE_LOG, rows
from skewkit.cli import parser, run


def _log(tmp_dir):
    path = os.path.join(tmp_dir, "site.log")
    with open(path, "w") as f:
        f.write("\n".join(SITE_LOG) + "\n")
    return path


def test_cli_topn_and_distinct(spark, tmp_dir):
    path = _log(tmp_dir)
    got = run(parser().parse_args(["topn", "--text", path]), spark)
    assert rows(got, "site", "url", "cnt", "rn") == [
        ("www.baidu.com", "url1", 1, 2), ("www.baidu.com", "url2", 2, 1),
        ("www.google.com", "url1", 3, 1), ("www.google.com", "url3", 2, 2)]
    every = run(parser().parse_args(["topn", "--text", path, "--distinct", "--all", "--salts", "9"]), spark)
    assert every.count() == 5


def test_cli_join_topn_and_lookup(spark, tmp_dir):
    path = _log(tmp_dir)
    got = run(parser().parse_args(["join-topn", "--text", path, "--right-text", path]), spark)
    assert rows(got, "site", "url", "cnt") == [
        ("www.baidu.com", "url1", 1), ("www.baidu.com", "url2", 2),
        ("www.google.com", "url1", 3), ("www.google.com", "url3", 2)]
    a, b = os.path.join(tmp_dir, "a.csv"), os.path.join(tmp_dir, "b.csv")
    with open(a, "w") as f:
        f.write("id,schoolname,num\n110,school1,1\n111,school2,2\n")
    with open(b, "w") as f:
        f.write("id,course\n110,zs\n220,ls\n")
    got = run(parser().parse_args(["lookup", "--left-csv", a, "--right-csv", b, "--key", "id"]), spark)
    assert rows(got) == [("110", "school1", "1", "zs"), ("111", "school2", "2", None)]


def test_cli_orc_distinct_counts(spark, site_log, tmp_dir):
    path = os.path.join(tmp_dir, "orc")
    site_log.write.orc(path)
    got = run(parser().parse_args(["topn", "--orc", path, "--distinct", "--salts", "9"]), spark)
    assert rows(got, "site", "url", "cnt") == [
        ("www.baidu.com", "url1", 1), ("www.baidu.com", "url2", 2),
        ("www.google.com", "url1", 3), ("www.google.com", "url3", 2)]
