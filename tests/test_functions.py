"""Column functions on hand-made values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from tillmarts.functions import arrays as A
from tillmarts.functions import dates as D
from tillmarts.functions import jsons as J
from tillmarts.functions import labels as B
from tillmarts.functions import lookups as L
from tillmarts.functions import numbers as N
from tillmarts.functions import texts as X
from tillmarts.operators.filters import filter_date_window, outside
from tillmarts.schemas import ATTACHMENT, REFERENCE_ITEM, struct_of


def evaluate(spark, values, kind, expression):
    """``expression`` over a column ``x`` holding ``values``, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_size_positions(spark):
    sizes = ["S", "M", "L", "XL", "XXL", "3XL", "4XL", "U", None]
    assert evaluate(spark, sizes, "string", B.size_order) == [1, 2, 3, 4, 5, 6, 7, None, None]
    assert evaluate(spark, sizes, "string", B.size_order_text) == [*"1234567", "U", None]


def test_first_colour_rule_wins(spark):
    codes = ["2249AREN00S", "1BLAMx", "1BLANBLAM", "1BLAMBLAN", "1BLAZ", "1RGME", "zzz", "aren", None, ""]
    assert evaluate(spark, codes, "string", B.colour) == [
        "Arena", "Blanco/Azul Marino", "Blanco", "Blanco", "Blanco/Azul", "Gris Medio",
        "Otro", "Otro", "Otro", "Otro",
    ]


def test_each_colour_code_alone(spark):
    codes = [c for c, _ in L.COLOUR_RULES]
    assert len(codes) == 70
    assert evaluate(spark, codes, "string", B.colour) == [n for _, n in L.COLOUR_RULES]


def test_office_has_a_default_and_months_have_none(spark):
    assert evaluate(spark, [1, 5, 6, None], "int", B.office_name) == [
        "PROVIDENCIA", "HUÉRFANOS", "OTRA OFICINA", "OTRA OFICINA",
    ]
    assert evaluate(spark, [1, 12, 13], "int", B.month_name) == ["Enero", "Diciembre", None]


def test_quarters_and_semesters(spark):
    months = list(range(1, 13))
    assert evaluate(spark, months, "int", B.quarter) == [f"Q{(m + 2) // 3}" for m in months]
    assert evaluate(spark, months, "int", B.semester) == ["S1"] * 6 + ["S2"] * 6


def test_integers_from_text(spark):
    texts = ["", " 7 ", "12.9", "-3.9", "abc", "NaN", None, "1e3"]
    assert evaluate(spark, texts, "string", N.coerce_int) == [None, 7, 12, -3, None, None, None, 1000]
    assert evaluate(spark, texts, "string", lambda c: N.safe_cast(c, "bigint")) == [
        None, 7, None, None, None, None, None, None,
    ]


def test_nullif_cast_is_strict_on_junk(spark):
    assert evaluate(spark, ["", "5", None], "string", lambda c: N.cast_nullif(c, "bigint")) == [None, 5, None]
    with pytest.raises(NumberFormatException):
        evaluate(spark, ["x"], "string", lambda c: N.cast_nullif(c, "bigint"))


def test_ratio_and_sign(spark):
    assert evaluate(spark, [0.0, 4.0, None], "double", lambda c: N.safe_ratio(F.lit(2), c)) == [None, 0.5, None]
    assert evaluate(spark, [9, 1, None], "int", lambda c: N.sign_flip(F.lit(3), c == 9)) == [-3, 3, 3]


def test_budget_falls_back(spark):
    texts = ["500", "1", "0", None]
    assert evaluate(spark, texts, "string", lambda c: N.fallback_budget(c, F.lit("80"), F.lit(4))) == [
        125.0, 20.0, 20.0, 20.0,
    ]
    assert evaluate(spark, texts, "string", lambda c: N.fallback_budget(c, F.lit("80"), F.lit(0)))[0] is None


def test_key_shows_missing_parts(spark):
    assert evaluate(spark, ["a", None], "string", lambda c: X.concat_key(c, F.lit("d"))) == ["a_d", "unknown_d"]


def test_not_in_is_unknown_for_null(spark):
    kind = lambda c: F.when(outside(c, ["a"]), "out").when(c.isNull(), "null").otherwise("in")
    assert evaluate(spark, ["a", "b", None], "string", kind) == ["in", "out", "null"]


def test_json_scalar_takes_scalars_only(spark):
    texts = ['{"a":1}', '{"a":"x"}', '{"a":{"b":1}}', '{"a":[1]}', '{"a":null}', "{}", "junk", None, '{"a":"[x"}']
    assert evaluate(spark, texts, "string", lambda c: J.json_scalar(c, "$.a")) == [
        "1", "x", None, None, None, None, None, None, "[x",
    ]


def test_items_of_both_shapes(spark):
    item = struct_of("id bigint")
    texts = ['{"items":[{"id":1},{"id":2}]}', '[{"id":3}]', ' [{"id":4}]', "[]", "{}", None, '{"items":[]}', "junk"]
    sizes = evaluate(spark, texts, "string", lambda c: F.size(F.coalesce(J.json_items(c, item), F.array())))
    assert sizes == [2, 1, 1, 0, 0, 0, 0, 0]


def test_list_of_an_object_is_no_list(spark):
    texts = ['{"href":"x"}', "[]", '[{"id":1,"reason":"r"}]', None]
    assert evaluate(spark, texts, "string", lambda c: F.size(J.json_list(c, REFERENCE_ITEM)))[2] == 1
    lists = evaluate(spark, texts, "string", lambda c: J.json_list(c, REFERENCE_ITEM))
    assert lists[0] is None and lists[1] == [] and lists[3] is None


def test_elements_stay_json_text(spark):
    texts = ['[{"a":1},"b",2]', '{"a":1}', None]
    assert evaluate(spark, texts, "string", J.json_texts) == [['{"a":1}', "b", "2"], None, None]


def test_nested_columns_become_text_and_all_become_strings(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('b', 'é') AS s, array(1, 2) AS l, map('k', 1) AS m")
    assert J.nested_to_json(df).collect()[0].asDict() == {"a": 1, "s": '{"b":"é"}', "l": "[1,2]", "m": '{"k":1}'}
    texts = J.stringify_all(spark.sql("SELECT 1 AS a, CAST(NULL AS int) AS b, true AS c"))
    assert texts.collect()[0].asDict() == {"a": "1", "b": None, "c": "true"}


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Tokyo"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epochs_do_not_depend_on_the_session_zone(spark, zone):
    assert evaluate(spark, [0, 86_399, 86_400, -1, None], "bigint", D.epoch_to_date) == [
        dt.date(1970, 1, 1), dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(1969, 12, 31), None,
    ]
    noon = [dt.datetime(2024, 1, 15, 12), dt.datetime(2024, 7, 15, 12)]
    assert evaluate(spark, noon, "timestamp_ntz", D.timestamp_to_epoch) == [1_705_320_000, 1_721_044_800]
    # Santiago is three hours behind in January and four in July.
    assert evaluate(spark, noon, "timestamp_ntz", D.local_to_epoch) == [
        1_705_320_000 + 3 * 3600, 1_721_044_800 + 4 * 3600,
    ]


def test_trailing_window_has_both_ends(spark, zone):
    end = 1_705_320_000 + 3 * 3600
    start = end - 4 * 86_400
    df = spark.createDataFrame([(start - 1,), (start,), (end,), (end + 1,)], "t bigint")
    kept = filter_date_window(df, "t", "2024-01-15 12:00:00", 3).collect()
    assert sorted(r.t for r in kept) == [start, end]


def test_week_labels(spark):
    days = [dt.date(2025, 1, 5), dt.date(2025, 1, 6)]
    assert evaluate(spark, days, "date", D.week_range) == ["2024-12-30 / 2025-01-05", "2025-01-06 / 2025-01-12"]
    assert evaluate(spark, days, "date", lambda c: D.year_month_label(F.year(c), F.month(c))) == ["2025/1"] * 2


ACTIONS = "array<struct<action_type:string,value:string>>"


def test_sum_over_a_set_of_types(spark):
    arrays = [
        [("purchase", "2"), ("omni_purchase", "3"), ("click", "9")],
        [("click", "x")],
        [],
        None,
        [("purchase", None)],
        [("purchase", "junk")],
    ]
    assert evaluate(spark, arrays, ACTIONS, lambda c: A.sum_in_set(c, "bigint")) == [5, 0, 0, 0, 0, 0]
    assert evaluate(spark, arrays, ACTIONS, lambda c: A.castable_in_set(c, "bigint")) == [
        True, True, True, True, True, False,
    ]


def test_last_video_of_an_attachment_list(spark):
    kind = f"array<{ATTACHMENT.simpleString()}>"
    arrays = [
        [("video_autoplay", ("v1",)), ("photo", ("f",)), ("video_autoplay", ("v2",))],
        [("photo", ("f",))],
        [],
        None,
        [("video_autoplay", None)],
    ]
    assert evaluate(spark, arrays, kind, A.any_video) == [True, False, False, False, True]
    assert evaluate(spark, arrays, kind, A.last_video_id) == ["v2", None, None, None, None]
