import decimal
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridloam.functions import display, formula
from gridloam.functions.geometry import decode_geometry, to_wgs84
from gridloam.functions.numbers import fixed_text, float_text, number_text, round_exact, strict_double, strict_int, to_double
from gridloam.functions.text import (
    clean_text,
    entity_id,
    entity_id_indexed,
    natural_id,
    normalize_status,
    osm_id,
    is_broken_bag,
    raw_attributes_json,
    version_date,
    with_measure_text,
)


def column(spark, values, expression, dtype):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression("v")).collect()]


def test_rounding_follows_the_binary_value(spark):
    rng = random.Random(7)
    values = [rng.randrange(-(10**9), 10**9) / 100000 for _ in range(3000)]
    values += [k / 100000 + 0.00005 for k in range(-50, 500)] + [0.5, 2.5, 0.03125, -0.03125, 1e15, 1.23456e14, 1e-7, -1e-9, 0.0]
    values += [rng.randrange(10**8, 10**15) / 10 ** rng.randrange(0, 6) for _ in range(3000)] + [300000000000.00006, 123456789012.5]
    got = column(spark, values, lambda c: round_exact(c, 4), "double")
    assert [repr(g) for g in got] == [repr(round(v, 4)) for v in values]


def test_float_text(spark):
    values = [10000000.0, 1e16, 123456789012345680.0, 1e-5, 0.0001, 12.5, -0.0, 0.0, 1.5e300, 9999999999999998.0, float("inf"), float("nan"), 0.00015]
    assert column(spark, values, float_text, "double") == [str(v) for v in values]


def test_number_text(spark):
    values = [500.0, 12.5, 0.0001, 1e-7, 1.5e-7, 1e21, 123456789.0, -3.0, 0.0, -0.0]
    assert column(spark, values, number_text, "double") == ["500", "12.5", "0.0001", "1e-7", "1.5e-7", "1e+21", "123456789", "-3", "0", "0"]


def test_fixed_text_breaks_real_ties_away_from_zero(spark):
    values = [1.005, 2.5, -2.5, 0.125, 1234.5678, 0.0, 999.995, -0.001]
    assert column(spark, values, lambda c: fixed_text(c, 2), "double") == ["1.00", "2.50", "-2.50", "0.13", "1234.57", "0.00", "1000.00", "-0.00"]


def test_fixed_text_of_large_numbers(spark):
    rng = random.Random(9)
    values = [rng.randrange(10**8, 10**15) / 1000 for _ in range(3000)] + [123456789012.5, 2.0**60, 1e15]
    want = [str(decimal.Decimal(v).quantize(decimal.Decimal("0.1"), decimal.ROUND_HALF_UP)) for v in values]
    assert column(spark, values, lambda c: fixed_text(c, 1), "double") == want


def test_to_double(spark):
    values = ["1d", "1_0", "nan", "1e3", " 2.5\t", "", None, "0x10", "1__0", ".5", "5.", "-inf", "abc", "1 2", " 7 "]
    want = [None, 10.0, None, 1000.0, 2.5, None, None, None, None, 0.5, 5.0, float("-inf"), None, None, 7.0]
    assert column(spark, values, to_double, "string") == want


def test_strict_casts(spark):
    assert column(spark, ["12.7", "-12.7"], lambda c: strict_int(c, "x"), "string") == [12, -12]
    for bad in (None, "abc"):
        with pytest.raises(Exception, match="required field missing or invalid: x"):
            column(spark, [bad], lambda c: strict_double(c, "x"), "string")


def test_clean_text(spark):
    values = ["  a\t", " b ", " \n", "", None, "\x1cc\x1f"]
    assert column(spark, values, clean_text, "string") == ["a", "b", None, None, None, "c"]


def test_normalize_status(spark):
    values = ["Existing", " In Planning ", "foo", "", None, "RETIRED"]
    assert column(spark, values, normalize_status, "string") == ["operational", "planned", "unknown", "unknown", "unknown", "decommissioned"]


def sha(*parts):
    return hashlib.sha256("|".join(parts).encode()).hexdigest()[:16]


def test_entity_ids(spark):
    df = spark.createDataFrame([(" a\t", None, "c", 1e7, 12.34565, 3), ("é", "b", None, None, 1e16, 4)], "n string, o string, c string, h double, p double, i int")
    plain = [r[0] for r in df.select(entity_id("n", "o", "c")).collect()]
    assert plain == [sha("a", "", "c"), sha("é", "b", "")]
    texts = with_measure_text(df, {"h_text": "h", "p_text": "p"})
    indexed = [r[0] for r in texts.select(entity_id_indexed("n", "o", "c", "h_text", "p_text", "i")).collect()]
    assert indexed == [sha("a", "", "c", str(round(1e7, 4)), str(round(12.34565, 4)), "3"), sha("é", "b", "", "", str(round(1e16, 4)), "4")]


def test_osm_id(spark):
    df = spark.createDataFrame([("way", "1", "w1"), (None, "1", "w1"), ("way", "", "w1"), (None, None, None), ("", "", "")], "t string, n string, f string")
    assert [r[0] for r in df.select(osm_id("t", "n", "f")).collect()] == ["way/1", "w1", "w1", None, None]


def test_natural_id_keeps_null_keys_apart(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 1, 1), ("a", None, 2), ("a", None, 3)], "k string, l int, i int")
    ids = [r[0] for r in df.select(natural_id("k", "l", distinguish=("i",))).collect()]
    assert ids[0] == ids[1] and len(set(ids)) == 3


def test_raw_attributes_json(spark):
    values = ['{"a": NaN, "b": ":NaN,"}', '{"a": ":NaN,"}', '{"a": Infinity, "b": [-Infinity, NaN], "c": "x \\" NaN"}', None]
    got = column(spark, values, lambda c: F.to_json(raw_attributes_json(c)), "string")
    assert got == ['{"a":null,"b":":NaN,"}', '{"a":":NaN,"}', '{"a":null,"b":[null,null],"c":"x \\" NaN"}', None]
    with pytest.raises(Exception):
        column(spark, ["nonsense"], lambda c: F.to_json(raw_attributes_json(c)), "string")
    assert column(spark, ["nonsense", '{"a": NaN}', None], is_broken_bag, "string") == [True, False, False]


def test_version_date_refuses_other_formats():
    with pytest.raises(ValueError):
        version_date("04.05.2026")


def test_decode_geometry(spark):
    df = spark.createDataFrame(
        [
            (1, {"type": "Polygon", "coordinates": "[[[0,0],[1,0],[1,1],[0,0]]]"}),
            (2, {"type": "MultiPolygon", "coordinates": "[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5,9],[6,5],[6,6],[5,5]]]]"}),
            (3, None),
        ],
        "i int, g struct<type:string,coordinates:string>",
    )
    got = {r["i"]: r["m"] for r in df.select("i", decode_geometry("g", "multipolygon").alias("m")).collect()}
    assert [len(got[1]), len(got[2]), got[3]] == [1, 2, None]
    assert (got[2][1][0][0]["x"], got[2][1][0][1]["x"]) == (5.0, 6.0)
    for i, kind in ((1, "Polygon"), (2, "MultiPolygon")):
        with pytest.raises(Exception, match=f"expected a point geometry, got {kind}"):
            df.where(F.col("i") == i).select(decode_geometry("g", "point")).collect()


def test_decode_line(spark):
    df = spark.createDataFrame([({"type": "LineString", "coordinates": "[[0,0],[1,2,9]]"},), (None,)], "g struct<type:string,coordinates:string>")
    line, none = [r["l"] for r in df.select(decode_geometry("g", "line").alias("l")).collect()]
    assert [(v["x"], v["y"]) for v in line] == [(0.0, 0.0), (1.0, 2.0)] and none is None


def test_other_coordinate_systems_are_refused():
    with pytest.raises(ValueError):
        to_wgs84("g", "point", 2056)


def test_category_steps(spark):
    values = [2.0, 1.999, 1.0, 0.5, 0.499, -1.0, None]
    want = ["high_feasibility", "moderate_feasibility", "moderate_feasibility", "low_feasibility", "critical_constraint", "critical_constraint", None]
    assert column(spark, values, formula.ratio_category, "double") == want
    assert column(spark, [3.0, None], lambda c: formula.feasibility_category(c, F.lit(True)), "double") == ["dc_hotspot"] * 2


def test_ratio_without_queue_is_null(spark):
    assert column(spark, [5.0], lambda c: formula.feasibility_ratio(c, F.lit(0.0)), "double") == [None]


def test_short_category_names(spark):
    assert column(spark, ["high", "high_feasibility", "dc_hotspot", "odd"], formula.canonical_category, "string") == [
        "high_feasibility", "high_feasibility", "dc_hotspot", "odd",
    ]


def test_power_and_operations(spark):
    assert column(spark, [999.0, 1000.0, 12.5, None], display.format_power, "double") == ["999 MW", "1.0 GW", "12.5 MW", "—"]
    assert column(spark, [3e18, 0.0, None, 1234.0], display.format_ops, "double") == ["3.0 × 10¹⁸", "NaN × 10-Infinity", "—", "1.2 × 10³"]
    assert column(spark, [1234567.0, 1234.5678, 0.5, None], display.format_count, "double") == ["1,234,567", "1,234.568", "0.5", "—"]
    assert column(spark, [None, 970.0], display.format_mw, "double") == ["—", "970.0 MW"]


def test_bubble_steps(spark):
    counts = [49, 50, 99, 100, 200, 500]
    assert column(spark, counts, lambda c: display.bubble_size(c, "osm"), "int") == [12, 12, 12, 16, 16, 20]
    assert column(spark, counts, lambda c: display.bubble_size(c, "clusters"), "int") == [14, 18, 18, 18, 24, 24]


def test_labels(spark):
    assert column(spark, ["low_feasibility", "odd"], display.category_short_label, "string") == ["Low", "odd"]
    assert column(spark, ["planned", None, "odd"], display.status_label, "string") == ["Planned", "Status unknown", "odd"]
    assert column(spark, ["city", None], display.precision_weight, "string") == [0.85, 0.85]


def test_counts_in_bubbles(spark):
    counts = [0, 999, 1000, 1049, 1050, 1250, 9949, 9999, 10_000, 10_499, 10_500, 1_234_567, None]
    want = ["0", "999", "1k", "1k", "1.1k", "1.3k", "9.9k", "10k", "10k", "10k", "11k", "1235k", None]
    assert column(spark, counts, display.abbreviated_count, "long") == want
