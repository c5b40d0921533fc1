"""Expressions on chosen values."""

import pytest
from pyspark.sql import functions as F

from specloom.functions import ids, text, urls
from specloom.functions.instants import instant, instant_micros, utc_month, utc_seconds_text


def values(spark, items, expression):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("v")).orderBy("i").select("v").collect()]


def test_instants(spark):
    same = ["2026-01-01T00:00:00Z", "2026-01-01T08:00:00+08:00", "2025-12-31T19:00:00-05:00", "2026-01-01", " 2026-01-01t00:00:00.000z ", "2026-01-01 00:00:00", "2026-01-01T00:00:00+0000"]
    assert len(set(values(spark, same, instant_micros))) == 1
    assert values(spark, [None, "", "soon", "12:30", "2026", "2026-13-01"], instant_micros) == [None] * 6
    assert values(spark, same[:1], lambda c: utc_seconds_text(instant_micros(c))) == ["2026-01-01T00:00:00Z"]


def test_instants_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, ["2026-01-01T02:00:00Z"], lambda c: utc_seconds_text(instant_micros(c))) == ["2026-01-01T02:00:00Z"]
        assert values(spark, ["2026-01-01", "2025-12-31T23:30:00-05:00"], lambda c: utc_month(instant(c))) == ["2026-01", "2026-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_urls(spark):
    assert values(spark, ["HTTPS://A.Example:443/x?Q=1#f", "http://a.example", "ftp://a/", "https://u:p@a/", "not a url", None], urls.canonical_url) == [
        "https://a.example:443/x?Q=1", "http://a.example/", None, None, None, None]
    hosts = ["a.example"]
    assert values(spark, ["https://a.example/", "https://b.A.example/", "https://a.example.evil/", "https://xa.example/", None], lambda c: urls.host_allowed(c, hosts)) == [True, True, False, False, False]
    assert values(spark, ["https://a.example:443/x", "http://a.example/x", "https://a.example/de/x"], lambda c: urls.admitted_url(c, hosts)) == ["https://a.example/x", None, None]
    assert values(spark, ["https://a/p?utm_source=1&b=2&gclid=3", "https://a/p?utm_x=1", "https://a/p"], urls.without_tracking) == ["https://a/p?b=2", "https://a/p", "https://a/p"]
    assert values(spark, ["https://a.cn/x", "https://a/zh-cn/x", "https://a/en/x", "https://a/fr/x", "https://a/defrost"], urls.url_language) == ["zh", "zh", "en", None, "en"]
    assert values(spark, ["https://a/x.PDF?y", "https://a/sitemap-2.xml.gz", "https://a/b.docx", "https://a/b", None], urls.url_kind) == ["pdf", "sitemap", "office", "page", None]
    assert values(spark, ["https://a/en-us/x/", "https://a/x", "https://a/english/x"], urls.without_locale) == ["/x", "/x", "/english/x"]
    assert values(spark, ["https://a/%7Eb/%c3%bc?q=a+b", "https://a/ü"], urls.percent_normal) == ["https://a/~b/%C3%BC?q=a+b", "https://a/%C3%BC"]
    assert values(spark, ["https://a/power/rack", "https://a/none"], lambda c: urls.best_line(c, [("x", ["cool"]), ("y", ["power"]), ("z", ["rack"])])) == ["y", "x"]


def test_text(spark):
    assert values(spark, ["  a  b\n", None, ""], text.collapse) == ["a b", None, ""]
    assert values(spark, ["=1", " +1", "-x", "@", "\tx", "ok", None], text.csv_safe) == ["'=1", "' +1", "'-x", "'@", "'\tx", "ok", ""]
    assert values(spark, ["<p>a&nbsp;<b>b</b></p><script>x</script><!-- c -->d"], text.visible_text) == ["a b d"]
    assert values(spark, ["Aurelon™ X-1 (R) Series", "aurelon x1"], text.identity_name) == ["aurelonx1", "aurelonx1"]
    assert values(spark, ["a/b c?.pdf"], text.safe_name) == ["a-b-c-.pdf"]
    assert values(spark, ["power SHELF x2 tray"], text.title_case) == ["Power SHELF x2 Tray"]


def test_ids(spark):
    assert values(spark, ['{"b":1.0,"a":"\\u00e9"}', "{", '{"a":NaN}', None], ids.canonical_json) == ['{"a":"é","b":1.0}', None, None, None]
    one, two = values(spark, ['{"b":1,"a":2}', ' {"a": 2, "b": 1} '], ids.json_digest)
    assert one == two and len(one) == 64


@pytest.mark.parametrize("n", [0, 1])
def test_order_free_digest(spark, n):
    df = spark.sql("SELECT array('a', 'b') AS x, array('b', 'a') AS y")
    r = df.select(ids.order_free_digest(F.col("x")), ids.order_free_digest(F.col("y"))).first()
    assert r[0] == r[1]
