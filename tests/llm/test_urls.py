import datetime

from salesmart.llm import urls
from tests.llm.oracle import compare

SF = "/root/testdata/sf0.001"


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def test_op1_equals_its_sql(spark):
    compare(spark, "op1_url_filters", SF)


def test_entries_count_as_of_the_fetch_day(spark):
    changes = [("domain:bad.org", "spam", day(10), True), ("domain:bad.org", "spam", day(20), False), ("domain:bad.org", "spam", day(30), True),
               ("prefix:ok.net/x", "adult", day(5), True), ("page:ok.net/x/y", "adult", day(5), True), ("page:ok.net/x/y", "adult", day(5), True),
               ("domain:org", "no", day(0), True), (None, "no", day(0), True), ("domain:bad.org", "spam", None, True),
               ("domain:same.io", "spam", day(7), False), ("domain:same.io", "spam", day(7), True)]
    captures = [(1, "http://a.bad.org/p?q", day(9)), (2, "http://a.bad.org/p?q", day(10)), (3, "HTTP://u@BAD.org:80", day(19)), (4, "http://bad.org", day(20)),
                (5, "http://bad.org#f", day(31)), (6, "http://ok.net/x/y?z", day(6)), (7, "http://ok.net/xx", day(6)), (8, None, day(6)), (9, "", day(6)),
                (10, "no scheme bad.org", day(15)), (11, "http://notbad.org/", day(15)), (12, "http://bad.org", None), (2, "http://a.bad.org/p?q", day(10)),
                (None, "http://" + "x." * 5000 + "bad.org/" + "p/" * 5000, day(15)), (13, "http://same.io", day(8))]
    got = urls.filter_captures(
        spark.createDataFrame([(*c, "clash") for c in captures], "capture_id long, url string, fetched date, key string"),
        spark.createDataFrame(changes, "key string, category string, day date, listed boolean"),
    ).collect()
    assert len(got) == len(captures)
    blocked = sorted((r.capture_id or 0, r.n_entries, r.categories) for r in got if r.blocked)
    assert blocked == [(0, 1, "spam"), (2, 1, "spam"), (2, 1, "spam"), (3, 1, "spam"), (5, 1, "spam"), (6, 2, "adult"), (13, 1, "spam")]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "capture_id long, url string, fetched date")
    changes = spark.createDataFrame([], "key string, category string, day date, listed boolean")
    assert urls.filter_captures(none, changes).count() == 0
    one = spark.createDataFrame([(1, "http://a.b", day(0))], none.schema)
    assert [r.blocked for r in urls.filter_captures(one, changes).collect()] == [False]
