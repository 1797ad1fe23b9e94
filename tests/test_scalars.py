import datetime as dt
import hashlib

from pyspark.sql import functions as F

from feedweave.functions import scalars as S
from feedweave.functions.text import paren_symbol, slug, url_slug


def column(spark, values, expression, type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type}")
    rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_natural_source_id(spark):
    df = spark.range(1)

    def one(c):
        return df.select(c).first()[0]

    assert one(S.natural_source_id("csv", id=F.lit("123"))) == "csv_123"
    link = F.lit("https://example.com/item")
    assert one(S.natural_source_id("rss", link=link)) == "rss_7b6cb5716bfd2697"
    none = F.lit(None).cast("string")
    assert one(S.natural_source_id("x", id=none, guid=F.lit("g"), link=link)) == "x_g"
    # Presence decides, not the value.
    assert one(S.natural_source_id("x", id=none, guid=F.lit("g"), present={"id": F.lit(True), "guid": F.lit(False)})) == "x_None"
    content = S.content_text({"b": F.lit("2"), "a": F.lit(None)})
    digest = hashlib.md5(b'{"a":null,"b":"2"}').hexdigest()[:16]
    assert one(S.natural_source_id("x", id=none, content=content)) == f"x_{digest}"


def test_safe_float(spark):
    given = ["123.45", "123", " 1e3 ", "1_000.5", "invalid", "", None, "2f", "1.0d", "nan", "0x10", ".5", "5.", "1__0", "-inf"]
    wanted = [123.45, 123.0, 1000.0, 1000.5, None, None, None, None, None, None, None, 0.5, 5.0, None, float("-inf")]
    assert column(spark, given, S.safe_float) == wanted


def test_safe_timestamp(spark):
    utc = dt.datetime(2024, 1, 15, 10, 30)
    given = {
        "2024-01-15T10:30:00Z": utc,
        "2024-01-15T10:30Z": utc,
        "2024-01-15 10:30": utc,
        "2024-01-15T12:30:00+02:00": utc,
        "2024-01-15T12:30:00+0200": utc,
        "Mon, 15 Jan 2024 10:30:00 GMT": utc,
        "Monday, 15 Jan 2024 12:30:00 +0200": utc,
        "15 Jan 2024 10:30": utc,
        "Jan 15, 2024 10:30:00": utc,
        "January 15, 2024": dt.datetime(2024, 1, 15),
        "01/15/2024": dt.datetime(2024, 1, 15),
        "2024/01/15 10:30:00": utc,
        "20240115T103000": utc,
        "2024-01-15": dt.datetime(2024, 1, 15),
        "invalid-date": None,
        "2024-13-01": None,
        "2024": None,
        "": None,
        None: None,
    }
    text = column(
        spark, list(given), lambda x: F.date_format(S.safe_timestamp(x), "yyyy-MM-dd HH:mm:ss")
    )
    assert text == [v and f"{v:%Y-%m-%d %H:%M:%S}" for v in given.values()]


def test_text_shapes(spark):
    given = ["Zebra  --  gym! 42", "!!!", "Test Product", "Ünï çødé x", "a" * 150, None, "-a_b-"]
    wanted = ["zebra-gym-42", "unknown", "test-product", "ünï-çødé-x", "a" * 100, None, "a_b"]
    assert column(spark, given, slug) == wanted
    assert column(spark, ["Bitcoin (BTC)", "x (btc)", "(A) (ETH)", None], paren_symbol) == ["BTC", None, "ETH", None]
    urls = ["https://x/Coins/LTC/a", "https://x/coin/foo-9", "https://x/"]
    assert column(spark, urls, url_slug) == ["ltc", "foo-9", None]


def test_run_id_and_elapsed(spark):
    a = F.lit("2024-01-15 10:30:00").cast("timestamp")
    b = F.lit("2024-01-15 10:30:12.5").cast("timestamp")
    run, seconds = spark.range(1).select(S.run_id(a, F.lit("k")), S.elapsed_seconds(a, b)).first()
    assert run == "run_20240115_103000_" + hashlib.md5(b"k").hexdigest()[:8]
    assert seconds == 12.5
