"""Literal fixtures with known answers (FIXTURES.md §2.3)."""

import random

from pyspark.sql import functions as F

from adsphere.functions import codec, geo, ip, tags


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).collect()[0].x


def test_user_ids_drop_blank(spark):
    df = spark.createDataFrame([("a", None, "  ", "\t", "")],
                               "imei string, mac string, idfa string, openudid string, androidid string")
    r = df.select(tags.user_ids().alias("ids"), tags.any_identifier().alias("p3")).collect()[0]
    assert r.ids == ["a"] and r.p3
    blank = spark.createDataFrame([("   ", None, None, None, None)], df.schema)
    r = blank.select(tags.user_ids().alias("ids"), tags.any_identifier().alias("p3")).collect()[0]
    assert r.ids == [] and r.p3   # passes P3, removed after E1


def test_location_split(spark):
    cases = {"广东省深圳市": ("广东省", "深圳市"), "广东省": ("广东省", "广东省"),
             "北京市海淀区": ("北京市海淀区", "北京市海淀区"), "A省B省C": ("A省", "B"),
             "A省省B": ("A省", ""), "": ("", "")}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r.c: (r.p, r.t) for r in df.select("c", ip.province_of(F.col("c")).alias("p"),
                                               ip.city_of(F.col("c")).alias("t")).collect()}
    assert got == cases


def test_area_label(spark):
    df = spark.createDataFrame([(" CZ88.NET",), ("ISP1",)], "a string")
    assert [r.x for r in df.select(ip.area_label(F.col("a")).alias("x")).collect()] == ["本机或本网络", "ISP1"]


def test_ip_numbers(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("255.255.255.255",), ("1.2.3",), ("1.2.3.256",),
                                ("a.b.c.d",), (None,)], "ip string")
    got = [r.n for r in df.select(ip.ip_to_number(F.col("ip")).alias("n")).collect()]
    assert got == [16909060, 4294967295, None, None, None, None]
    back = df.limit(2).select(ip.number_to_ip(ip.ip_to_number(F.col("ip"))).alias("x")).collect()
    assert [r.x for r in back] == ["1.2.3.4", "255.255.255.255"]


_B32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def _bisect_geohash(lat, lon, p=8):
    la, lo, bits, even = [-90.0, 90.0], [-180.0, 180.0], [], True
    while len(bits) < 5 * p:
        r, v = (lo, lon) if even else (la, lat)
        mid = (r[0] + r[1]) / 2
        if v >= mid:
            bits.append(1)
            r[0] = mid
        else:
            bits.append(0)
            r[1] = mid
        even = not even
    return "".join(_B32[int("".join(map(str, bits[i:i + 5])), 2)] for i in range(0, len(bits), 5))


def test_geohash_known_values(spark):
    rows = [(57.64911, 10.40744, "u4pruydq"), (0.0, 0.0, "s0000000"),
            (-90.0, -180.0, "00000000"), (90.0, 180.0, "zzzzzzzz")]
    df = spark.createDataFrame(rows, "lat double, lon double, want string")
    for r in df.select("want", geo.geohash8(F.col("lat"), F.col("lon")).alias("g")).collect():
        assert r.g == r.want


def test_geohash_equals_bisection(spark):
    rnd = random.Random(7)
    pts = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(500)]
    pts += [(-90 + k * 180 / 64, -180 + k * 360 / 64) for k in range(65)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    for p in (5, 8):
        for r in df.select("lat", "lon", geo.geohash(F.col("lat"), F.col("lon"), p).alias("g")).collect():
            assert r.g == _bisect_geohash(r.lat, r.lon, p), (r.lat, r.lon, p)


def test_area_json(spark):
    body = '{"regeocode":{"addressComponent":{"businessAreas":%s}}}'
    rows = [(body % '[{"name":"A"},{"name":"B"}]',), (body % "[[]]",), ("oops",), (None,)]
    df = spark.createDataFrame(rows, "r string")
    assert [r.x for r in df.select(geo.areas_text(F.col("r")).alias("x")).collect()] == ["A,B", "", "", ""]


def test_keyword_and_area_tags(spark):
    df = spark.createDataFrame([("a,,b,,",), ("",), (None,), (",,",)], "k string")
    got = [r.x for r in df.select(tags.keyword_tags(F.col("k")).alias("x")).collect()]
    assert got == [["KW_a", "KW_", "KW_b"], ["KW_"], [], []]
    got = [r.x for r in df.select(tags.area_tags(F.col("k")).alias("x")).collect()]
    assert got == [["BA_a", "BA_", "BA_b"], [], [], []]


def test_null_fields_read_null(spark):
    df = spark.createDataFrame([(None, None)], "sex string, devicetype long")
    r = df.select(tags.simple_tag(tags.SEX, F.col("sex")).alias("s"),
                  tags.device_tags(F.lit("c"), F.lit("o"), F.lit("n"), F.col("devicetype"),
                                   F.lit(None).cast("string")).alias("d")).collect()[0]
    assert r.s == ["SEX_null"]
    assert "DT_0" in r.d and "DEVICE_null" in r.d


def test_codec(spark):
    df = spark.createDataFrame([("(BA_a,1.0),(KW_b,0.9)",), ("(APP_x,y,1.0)",)], "t string")
    got = [r.m for r in df.select(codec.decode_map(F.col("t")).alias("m")).collect()]
    assert got == [{"BA_a": 1.0, "KW_b": 0.9}, {"APP_x,y": 1.0}]
    back = df.select(codec.encode_map(codec.decode_map(F.col("t"))).alias("x")).collect()
    assert [r.x for r in back] == ["(BA_a,1.0),(KW_b,0.9)", "(APP_x,y,1.0)"]


def test_geohash_of_a_missing_coordinate_is_missing(spark):
    from adsphere.functions.geo import geohash8
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (None, None)], "lat double, lon double")
    assert [r[0] for r in df.select(geohash8(F.col("lat"), F.col("lon"))).collect()] == [None] * 3
