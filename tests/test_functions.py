import pytest
from helpers import rows
from pyspark.sql import functions as F

from candlewick.functions import geo, numbers, text, times, web


def test_surrogate_key_goldens(spark):
    df = spark.createDataFrame(
        [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)], "x string, y string, z string"
    )
    keys = df.select(text.surrogate_key("x").alias("one"), text.surrogate_key("x", "y", "z").alias("all")).collect()
    assert [tuple(k) for k in keys] == [
        ("0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]


@pytest.mark.parametrize(
    "terms, added, subtracted",
    [((1, 2, 3), 6, -4), ((1, None, 3), 4, -2), ((None, None, 2), 2, -2), ((None, None, None), 0, 0), ((3, 2, 1), 6, 0)],
)
def test_safe_add_and_subtract(spark, terms, added, subtracted):
    df = spark.createDataFrame([terms], "a int, b int, c int")
    assert df.select(numbers.safe_add("a", "b", "c"), numbers.safe_subtract("a", "b", "c")).first() == (added, subtracted)


@pytest.mark.parametrize(
    "n, d, expected",
    [(6, 0, None), (10, 5, 2), (None, None, None), (None, 0, None), (17, None, None), (0, None, None), (None, 9, None), (0, 5, 0)],
)
def test_safe_divide(spark, n, d, expected):
    df = spark.createDataFrame([(n, d)], "n int, d int")
    assert df.select(numbers.safe_divide("n", "d")).first()[0] == expected


def test_safe_divide_of_expressions(spark):
    df = spark.createDataFrame([(6, 3, 2), (5, 0, 4), (5, None, 2)], "n int, a int, b int")
    got = [r[0] for r in df.select(numbers.safe_divide("n", F.col("a") * F.col("b"))).collect()]
    assert got == [1.0, None, None]


def test_bucket_number_goldens(spark):
    cases = [(190000.0, 0), (290000.0, 1), (320000.0, 2), (399999.99, 2), (400000.0, 3), (470000.0, 3), (510000.0, 4), (610000.0, 5)]
    df = spark.createDataFrame(cases, "amount double, bucket int")
    assert df.filter(numbers.bucket_number("amount", 200000, 600000, 4) != F.col("bucket")).count() == 0


def test_slug(spark):
    cases = {"": "", None: "", "!Hell0 world-hi": "hell0_world_hi", "0Hell0 world-hi": "_0hell0_world_hi"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", text.slug("t")).collect()} == cases
    assert {k: text.slug_name(k) for k in cases} == cases


def test_haversine_goldens(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    c = [F.col(x) for x in "abcd"]
    got = df.select(F.round(geo.haversine_distance(*c)), F.round(geo.haversine_distance(*c, unit="km"))).first()
    assert tuple(got) == (267.0, 430.0)
    with pytest.raises(ValueError):
        geo.haversine_distance(*c, unit="m")


def test_url_goldens(spark):
    cases = [
        ("www.google.co.uk?utm_source=google&utm_medium=cpc", "www.google.co.uk", "", "google"),
        ("http://witanddelight.com/2018/01/half-marathon/?utm_source=google", "witanddelight.com", "2018/01/half-marathon/", "google"),
        ("https://www.nytimes.com/2018/01/01/blog", "www.nytimes.com", "2018/01/01/blog", None),
        ("android-app://m.facebook.com/", "m.facebook.com", None, None),
        ("docs.nytimes.com/2021/01/01/index.js?utm_source=", "docs.nytimes.com", "2021/01/01/index.js", None),
        ("https://m.facebook.com/", "m.facebook.com", "", None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "u string")
    got = df.select("u", web.url_host("u"), web.url_path("u"), web.url_parameter("u", "utm_source")).collect()
    for row, (url, host, path, source) in zip(got, cases):
        assert row[1] == host and row[3] == source
        assert path is None or row[2] == path, url


def test_url_parameter_is_a_plain_text_split(spark):
    df = spark.createDataFrame([("http://x.org/?xpage=1&page=2",)], "u string")
    assert df.select(web.url_parameter("u", "page")).first()[0] == "1"


def test_bucket_edges_and_widths(spark):
    df = spark.sql("SELECT timestamp '2024-01-01 10:15:00' AS t UNION ALL SELECT timestamp '2024-01-01 10:14:59.999999'")
    got = rows(df.select(times.bucket_start("t", "15 minutes").cast("string"), times.bucket_start("t", "6 hours").cast("string")))
    assert got == [("2024-01-01 10:00:00", "2024-01-01 06:00:00"), ("2024-01-01 10:15:00", "2024-01-01 06:00:00")]


def test_arrival_order_is_time_then_id(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp '2024-01-01 00:00:00', 9223372036854775807),
        (timestamp '2024-01-01 00:00:00', -5L), (timestamp '2024-01-01 00:00:00.000001', -9223372036854775807L),
        (timestamp '1969-12-31 23:59:59', 3L) AS t(time, id)""")
    packed = [tuple(r) for r in df.orderBy(times.arrival_order()).collect()]
    assert packed == [tuple(r) for r in df.orderBy("time", "id").collect()]
