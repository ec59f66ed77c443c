import math
import random
import time

import pytest
from pyspark.sql import functions as F

from tallymark.functions import des, geo
from tallymark.functions.des import decrypt, des_decrypt, des_encrypt, encrypt
from tallymark.functions.ids import cell_values, combined_id, md5_id, to_long_form
from tallymark.functions.ip import ip_number, province_city
from tallymark.functions.records import app_record, feature_line, first_geo, impressions, rule_line


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    ("line", "rule", "feature"),
    [
        ("a:1:text", ("a", "text", False), ("a", "text", False)),
        ("a:1:te:xt", ("a", "te:xt", False), ("a", "te", False)),
        ("a:1:text:1", ("a", "text", True), ("a", "text", True)),
        ("a:1:text:0", ("a", "text", False), ("a", "text", False)),
        ("a:1:b:c:1", ("a", "b:c", True), ("a", "b", False)),
        ("a:1", ("a", "", False), None),
        ("a", ("a", "", False), None),
        ("", ("", "", False), None),
        ("a:1:1", ("a", "1", False), ("a", "1", False)),
        ("a:1::1", ("a", "", True), ("a", "", True)),
        ("a:1:\n好\n:1", ("a", "\n好\n", True), ("a", "\n好\n", True)),
    ],
)
def test_lines(spark, line, rule, feature):
    assert tuple(one(spark, rule_line(F.col("x")), line)) == rule
    found = one(spark, feature_line(F.col("x")), line)
    assert (found and tuple(found)) == feature


def test_records(spark):
    assert tuple(one(spark, app_record(F.col("x")), "a:5:1.5:1")) == ("a", 5, 1.5, 1)
    assert tuple(one(spark, app_record(F.col("x"), "feature"), "a:0:5:12.5:z")) == ("a", 5, 12.5, 0)
    assert tuple(one(spark, app_record(F.col("x")), "a::x")) == ("a", None, None, None)
    assert tuple(one(spark, first_geo(F.array(F.lit("bad"), F.lit("g:1,x"), F.col("x"))), "g:116.39742,39.90919")) == ("g", 116.39742, 39.90919)
    assert one(spark, first_geo(F.array(F.col("x"))), None) is None
    assert [tuple(r) for r in one(spark, impressions(F.col("x")), "12:7:1,bad,13:8:0,")] == [(12, 7, 1), (13, 8, 0)]


def test_ids(spark):
    assert one(spark, md5_id(F.col("x")), "a" * 32) == "a" * 32
    assert one(spark, md5_id(F.col("x")), "abc") == "900150983cd24fb0d6963f7d28e17f72"
    assert one(spark, md5_id(F.col("x")), None) is None
    assert one(spark, combined_id(F.lit("s"), F.col("x"), F.lit(2)), " Raw") == " Raw"
    assert one(spark, combined_id(F.lit(None).cast("string"), F.col("x"), F.lit(1)), " ABC ") == "900150983cd24fb0d6963f7d28e17f72"


def test_long_form_keeps_filled_cells(spark):
    frame = spark.createDataFrame([("k", 0, "", None, [], [1], True, {"a": 1}, 1.5), (None, 1, "x", 1, [1], [1], True, {}, 0.0)], "id string, a int, b string, c int, d array<int>, e array<int>, f boolean, g map<string,int>, h double")
    assert {(r.rowkey, r.qualifier, r.value) for r in to_long_form(frame, "id").collect()} == {("k", "e", "[1]"), ("k", "f", "true"), ("k", "g", '{"a":1}'), ("k", "h", "1.5")}
    assert [r.a for r in one(spark, cell_values(F.col("x"), "a int"), '{"a":1}\n{"a":2}')] == [1, 2]


def test_des(spark):
    key = bytes.fromhex("133457799BBCDFF1")
    assert encrypt(bytes(8), "\0" * 8).startswith("8ca64de9c1b123a7")  # a published vector
    for text in ("", "1234567", "12345678", "好 text"):
        assert decrypt(key, encrypt(key, text)) == text
    frame = spark.createDataFrame([("a",), (None,), ("zz",)], "x string")
    twice = frame.select(des_decrypt(des_encrypt(F.col("x"), key), key).alias("y"), des_decrypt(F.col("x"), key).alias("z"))
    assert [tuple(r) for r in twice.collect()] == [("a", None), (None, None), ("zz", None)]
    with pytest.raises(ValueError):
        des_encrypt(F.col("x"), b"short")


def test_des_of_many_texts(spark):
    """Cipher blocks by the plain definition; 400,000 blocks and back, which took minutes a block at a time."""

    def plain(value, keys):
        value = des._pick(value, des.INITIAL, 64)
        left, right = value >> 32, value & 0xFFFFFFFF
        for key in keys:
            wide, out = des._pick(right, des.EXPAND, 32) ^ key, 0
            for k in range(8):
                six = wide >> (42 - 6 * k) & 63
                out = out << 4 | des.BOXES[k][(six & 32 | (six & 1) << 4) + (six >> 1 & 15)]
            left, right = right, left ^ des._pick(out, des.PERMUTE, 32)
        return des._pick(right << 32 | left, des.FINAL, 64)

    key = bytes.fromhex("133457799BBCDFF1")
    keys, data = des._round_keys(key), random.Random(5).randbytes(8 * 300)
    assert des._crypt(data, keys) == b"".join(plain(int.from_bytes(data[k : k + 8], "big"), keys).to_bytes(8, "big") for k in range(0, len(data), 8))
    assert des._crypt(des._crypt(data * 1000, keys), keys[::-1]) == data * 1000
    texts = [None, "", "好" * 9, *["x" * n for n in range(40)], "long " * 500_000]
    cipher, back = des_encrypt(F.col("x"), key), des_decrypt(F.col("c"), key)
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", cipher.alias("c")).select("x", "c", back.alias("y")).collect()
    assert all(r.x == r.y and r.c == (None if r.x is None else encrypt(key, r.x)) for r in rows) and len(rows) == len(texts)
    odd = [("00" * 12,), ("0",), ("",), (encrypt(key, "a")[:-2],), ("00" * 8,)]  # no whole blocks, no padding
    assert [r.y for r in spark.createDataFrame(odd, "c string").select(back.alias("y")).collect()] == [None] * 5
    lines = spark.range(50_000).select(F.format_string("Customer#%09d", "id").alias("x"))
    began = time.perf_counter()
    assert lines.where(des_decrypt(des_encrypt(F.col("x"), key), key) == F.col("x")).count() == 50_000
    assert time.perf_counter() - began < 15


def test_geo(spark):
    point = lambda *v: [F.lit(float(x)) for x in v]
    assert one(spark, geo.haversine(*point(111.94, 42.89, 111.941, 42.89))) == pytest.approx(81.47, abs=0.02)
    assert geo.degrees_of(1000) == pytest.approx(0.00899322, abs=1e-8)
    box = one(spark, geo.bounds(*point(116.4, 39.9), 1000))
    assert box.lat_max - box.lat_min == pytest.approx(2 * geo.degrees_of(1000), abs=1e-9)
    assert one(spark, geo.haversine(F.lit(116.4), F.lit(39.9), F.lit(box.lng_max), F.lit(39.9))) == pytest.approx(1000, abs=0.01)
    lng, lat = geo.gcj02_to_wgs84(*point(0, 0))
    assert tuple(one(spark, F.array(lng, lat))) == (0.0, 0.0)
    lng, lat = geo.gcj02_to_wgs84(*point(116.404, 39.915))
    found = one(spark, F.array(lng, lat))
    assert found == pytest.approx([116.39775550083061, 39.91359571849836], abs=1e-7)
    lng, lat = geo.bd09_to_gcj02(*point(116.404, 39.915))
    assert one(spark, F.array(lng, lat)) == pytest.approx([116.39762729119315, 39.90865673957631], abs=1e-7)
    for low in geo.BANDS[:-1]:  # the border belongs to the upper band
        (_, at), (_, below) = geo.mercator_to_bd09(*point(1.2e7, low)), geo.mercator_to_bd09(*point(1.2e7, low - 1))
        assert abs(one(spark, at) - one(spark, below)) < 0.02
    assert one(spark, geo.mercator_to_bd09(*point(-1.2e7, -4.8e6))[0]) > 0
    x, y = geo.plane_point(*point(116, 40))
    assert one(spark, x) == pytest.approx(116 * math.cos(math.radians(40)), abs=1e-3)


@pytest.mark.parametrize(("ip", "number"), [("1.2.3.4", 16909060), (" 255.255.255.255 ", 4294967295), ("1.2", None), ("256.1.1.1", None), ("a.b.c.d", None), ("", None), (None, None), ("1.2.3.-4", None)])
def test_ip_number(spark, ip, number):
    assert one(spark, ip_number(F.col("x")), ip) == number


@pytest.mark.parametrize(
    ("name", "found"),
    [("北京市海淀区", ("北京", "北京")), ("广西壮族自治区南宁市", ("广西", "南宁")), ("西藏拉萨市", ("西藏", "拉萨")), ("内蒙古呼和浩特市", ("内蒙古", "呼和浩特")), ("黑龙江省哈尔滨市", ("黑龙江", "省哈尔滨")), ("广东省深圳市", ("广东", "深圳")), ("广东", ("广东", "")), ("美国", None), (None, None)],
)
def test_province_city(spark, name, found):
    got = one(spark, province_city(F.col("x")), name)
    assert (got and tuple(got)) == found
