from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tessera.functions import calendar, casts, geo, nested, text
from tessera.functions.vectors import dot, literal_vector


def one(spark, column, **values):
    frame = spark.range(1).select(*[(v if isinstance(v, F.Column) else F.lit(v)).alias(k) for k, v in values.items()] or ["id"])
    return frame.select(column.alias("x")).first()["x"]


def test_ansi_stays_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize(
    "value, expected",
    [("3", 3), ("3.0", 3), ("-2.9", -2), ("", None), ("N/A", None), (None, None), ("1e300", None), ("NaN", None)],
)
def test_whole_numbers_may_carry_decimals(spark, value, expected):
    assert one(spark, casts.to_int("v"), v=F.lit(value).cast("string")) == expected


@pytest.mark.parametrize(
    "value, strict, whole",
    [("1234567890123456789", 1234567890123456789, 1234567890123456789), ("3.0", None, 3), ("1234567890123456789.0", None, 1234567890123456789), ("x", None, None), ("", None, None), ("99999999999999999999", None, None)],
)
def test_long_ids(spark, value, strict, whole):
    assert one(spark, casts.to_long("v"), v=value) == strict
    assert one(spark, casts.to_whole_long("v"), v=value) == whole


def test_flags_keep_null(spark):
    got = spark.createDataFrame([("t",), ("f",), ("x",), (None,)], "v string").select(casts.flag("v")).collect()
    assert [r[0] for r in got] == [True, False, False, None]


@pytest.mark.parametrize("value, expected", [("1.5 baths", 1.5), ("2 shared baths", 2.0), ("Half-bath", None), ("1.2.3", None)])
def test_first_number(spark, value, expected):
    assert one(spark, casts.first_number("v"), v=value) == expected


@pytest.mark.parametrize("value, expected", [("97%", 97.0), ("N/A", None), ("", None)])
def test_percent(spark, value, expected):
    assert one(spark, casts.percent("v"), v=value) == expected


def test_calendar(spark):
    day = F.lit(datetime.date(2024, 2, 25))
    frame = spark.range(1).select(*[c.alias(n) for n, c in calendar.calendar_columns(day).items()])
    assert frame.first().asDict() == {
        "date_id": 20240225,
        "year": 2024,
        "month": 2,
        "month_name": "February",
        "quarter": 1,
        "day_of_week": 1,
        "day_name": "Sunday",
        "is_weekend": True,
        "season": "Winter",
    }


def test_seasons(spark):
    months = spark.range(1, 13).select(F.make_date(F.lit(2023), F.col("id").cast("int"), F.lit(1)).alias("d"))
    got = [r[0] for r in months.orderBy("d").select(calendar.season(F.col("d"))).collect()]
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]


def test_citations(spark):
    assert one(spark, text.strip_citations(F.col("v")), v="a[1] b[ 22 ] c[x]") == "a b c[x]"


def test_safe_name(spark):
    assert one(spark, text.safe_name(F.col("v")), v="Bay Terrace/East") == "Bay_Terrace-East"


def test_numbers(spark):
    got = one(spark, text.numbers_in(F.col("v")), v="36,445 of 4.82 and 36445; v2 1,234,567")
    assert set(got) == {"36445", "4.82", "1234", "567"}


def test_strip_takes_all_white_space(spark):
    assert one(spark, text.strip(F.col("v")), v="　\t x y  \n") == "x y"


@pytest.mark.parametrize("value, expected", [("x" * 19, False), ("x" * 20, True), ("  " + "x" * 19 + "\n", False), (None, False)])
def test_least_length(spark, value, expected):
    assert one(spark, text.long_enough(F.col("v"), 20), v=F.lit(value).cast("string")) is expected


def test_keyword_guard_ignores_case(spark):
    assert one(spark, text.contains_any(F.col("v"), text.CITY_WORDS), v="A place in BROOKLYN.")
    assert not one(spark, text.contains_any(F.col("v"), text.CITY_WORDS), v="Bayswater, Perth")


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<h2>First</h2><p>late</p>", []),
        ("<p>One <b>bold</b>move</p><p> </p><p>Two</p><H3 id=x>h</H3><p>no</p>", ["One bold move", "Two"]),
        ("<p class='a'>open<p>next<div>out</div>", ["open", "next"]),
        ("<p>a &amp; b&nbsp;</p><script>var p='<p>no</p>'</script><!-- <p>no</p> -->", ["a & b"]),
        ("no paragraphs", []),
        ("<pre>x</pre><p>y</p>", ["y"]),
    ],
)
def test_intro_paragraphs(spark, html, expected):
    assert one(spark, text.intro_paragraphs(F.col("v")), v=html) == expected


def test_stable_key_separates_parts_and_takes_null(spark):
    key = text.stable_key(F.col("a"), F.col("b"))
    frame = spark.createDataFrame([("x", "yz"), ("xy", "z"), (None, "z"), ("", "z")], "a string, b string")
    keys = [r[0] for r in frame.select(key).collect()]
    assert len({*keys[:3]}) == 3 and keys[2] == keys[3] and all(k >= 0 for k in keys)


def test_json_and_lookup(spark):
    assert one(spark, nested.parse_or_null(F.col("v"), "k int")["k"], v="not json") is None
    assert one(spark, nested.literal_lookup({"A": "a"}, F.col("v")), v="B") is None
    assert one(spark, nested.array_to_json(F.array(F.lit("a"), F.lit('b"c'))), v="") == '["a","b\\"c"]'


def test_dot_is_in_double(spark):
    assert one(spark, dot(literal_vector([1, 2, 3]), literal_vector([4, 5, 6]))) == 32.0


def ring(*points):
    return "array(" + ", ".join(f"named_struct('lon', {x}D, 'lat', {y}D)" for x, y in points) + ")"


L_SHAPE = ring((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0))
HOLE = ring((0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5))
ISLAND = ring((10, 10), (11, 10), (11, 11), (10, 11), (10, 10))


@pytest.mark.parametrize(
    "x, y, expected",
    [
        (3, 1, True),
        (1, 3, True),
        (3, 3, False),
        (1, 1, False),
        (0.25, 0.25, True),
        (10.5, 10.5, True),
        (0, 1.7, True),
        (4, 1, False),
        (3, 2, False),
        (3, 0, True),
    ],
)
def test_point_in_shape_with_hole_and_island(spark, x, y, expected):
    frame = spark.sql(f"SELECT array(array({L_SHAPE}, {HOLE}), array({ISLAND})) AS shape, {x}D AS lon, {y}D AS lat")
    edged = frame.withColumn("edges", geo.shape_edges("shape"))
    assert edged.select(geo.inside("lon", "lat", "edges")).first()[0] is expected


def test_centroids_differ_as_described(spark):
    # the square with its closing vertex, and a hole in its eastern half wound the same way
    square = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    hole = ring((2, 1), (4, 1), (4, 3), (2, 3))
    frame = spark.sql(f"SELECT array(array({square}, {hole})) AS shape")
    vertex, area = frame.select(geo.vertex_centroid("shape"), geo.area_centroid("shape")).first()
    assert vertex["lon"] == pytest.approx(1.6) and vertex["lat"] == pytest.approx(1.6)
    assert area["lon"] == pytest.approx((16 * 2 - 4 * 3) / 12) and area["lat"] == pytest.approx(2.0)


def test_flat_shape_falls_back_to_vertices(spark):
    frame = spark.sql(f"SELECT array(array({ring((1, 1), (3, 1), (1, 1))})) AS shape")
    assert frame.select(geo.area_centroid("shape")).first()[0]["lat"] == 1.0


def test_repeated_vertices_go(spark):
    frame = spark.sql(f"SELECT array(array({ring((0, 0), (0, 0), (1, 0), (1, 0), (1, 1), (0, 0))})) AS shape")
    tidy = frame.select(geo.tidy_shape("shape")).first()[0]
    assert [(p["lon"], p["lat"]) for p in tidy[0][0]] == [(0, 0), (1, 0), (1, 1), (0, 0)]


def test_zero_coordinate_is_a_point(spark):
    null = F.lit(None).cast("double")
    assert one(spark, geo.point(F.lit(0.0), F.lit(5.0))).asDict() == {"lon": 5.0, "lat": 0.0}
    assert one(spark, geo.point(null, F.lit(5.0))) is None
