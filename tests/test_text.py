import datetime as dt

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.functions import text as T


def values(spark, rows, **cols):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [tuple(r) for r in df.select(*[c.alias(k) for k, c in cols.items()]).collect()]


def test_split_lines_is_pythons(spark):
    texts = ["", "a", "a\n", "a\n\n", "a\r\nb\rc", "x y\u0085z", "\n", "a\x0bb\x0cc\x1cd\x1de\x1ef"]
    got = values(spark, texts, v=T.split_lines(F.col("x")))
    assert [g[0] for g in got] == [t.splitlines() for t in texts]


def test_scalars(spark):
    assert values(spark, ["Straße  X "], a=T.casefold(F.col("x")), b=T.collapse(F.col("x")), c=T.slug(F.col("x"))) == [("strasse  x ", "Straße X", "strasse-x")]
    assert values(spark, ["2026-1-5", "2026-01-05", "2026-02-31", None], v=T.iso_date(F.col("x"))) == [(None,), (dt.date(2026, 1, 5),), (None,), (None,)]
    assert values(spark, ["1_0", "2.0", "7", "-3", ""], v=T.whole(F.col("x"))) == [(None,), (None,), (7,), (-3,), (None,)]
    assert values(spark, ["nan", "1.5", "x"], v=T.number(F.col("x"))) == [(None,), (1.5,), (None,)]
    assert values(spark, ["eligibility[3].haircut_pct", "plain"], s=T.suffix(F.col("x")), p=T.prefix(F.col("x")), g=T.group_index(F.col("x"), "eligibility")) == [("haircut_pct", "eligibility", 3), ("plain", "plain", None)]
    assert values(spark, ["August 3, 2026"], v=T.long_date(F.col("x"))) == [("2026-08-03",)]
    assert values(spark, ["<a b='c'>&"], v=T.html_escape(F.col("x"))) == [("&lt;a b=&#x27;c&#x27;&gt;&amp;",)]


def plain_business_day(d, n):
    while n:
        d += dt.timedelta(1)
        n -= d.weekday() < 5
    return d


def test_business_days(spark):
    days = [dt.date(2026, 7, 6) + dt.timedelta(i) for i in range(14)]
    df = spark.createDataFrame([(d, n) for d in days for n in (0, 1, 3, 5, 10)], "d date, n int")
    for r in df.select("d", "n", T.add_business_days(F.col("d"), F.col("n")).alias("e")).collect():
        assert r.e == plain_business_day(r.d, r.n)
    assert spark.createDataFrame([(days[0], -1)], "d date, n int").select(T.add_business_days(F.col("d"), F.col("n"))).first()[0] is None


@given(st.text(max_size=40))
def test_plain_split_has_no_trailing_line(t):
    assert len((t + "\n").splitlines()) >= len(t.splitlines())


def test_required_and_decimals(spark):
    import pytest

    assert values(spark, ["Dated:  May 1"], v=T.required(F.col("x"), "dated:\\s*(\\w+ \\d+)")) == [("May 1",)]
    with pytest.raises(Exception, match="required pattern not found"):
        values(spark, ["none"], v=T.required(F.col("x"), "dated: (.+)"))
    assert values(spark, ["9.5", "10", "0.1234", "100.0"], v=T.plain_decimal(F.col("x").cast("double"))) == [("9.5",), ("10",), ("0.1234",), ("100",)]
