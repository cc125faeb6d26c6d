"""Stock and movements, the ledger against a plain day-by-day count."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillmarts.operators.windows import forward_fill, running_sum
from tillmarts.plans import shop, stock
from tillmarts.schemas import CONSUMPTION, RECEPTION

MOVES = "fecha date, variant_id string, office_id string, ingreso double, salida double"
FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 20)


def brute_force(pairs, moves):
    """Running stock of each pair, one day after the other."""
    out = set()
    for variant, office in pairs:
        total = 0.0
        day = FIRST
        while day <= LAST:
            total += sum(i - o for d, v, f, i, o in moves if (d, v, f) == (day, variant, office))
            out.add((day, variant, office, total, total))
            day += dt.timedelta(days=1)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_ledger_equals_a_daily_count(spark, seed):
    rng = random.Random(seed)
    pairs = [(str(v), str(f)) for v in range(4) for f in range(3) if rng.random() < 0.7]
    moves = [
        (
            FIRST + dt.timedelta(days=rng.randint(-3, 24)),
            str(rng.randint(0, 4)),
            str(rng.randint(0, 2)),
            float(rng.randint(0, 5)),
            float(rng.randint(0, 5)) / 4,
        )
        for _ in range(150)
    ]
    held = spark.createDataFrame(pairs + pairs[:2], "variant_id string, office_id string")
    out = stock.stock_ledger(held, spark.createDataFrame(moves, MOVES), str(FIRST), str(LAST)).collect()
    assert len(out) == len(set(map(tuple, out))) == 20 * len(pairs)
    assert set(map(tuple, out)) == brute_force(pairs, moves)


def test_ledger_without_movements_and_with_null_keys(spark):
    held = spark.createDataFrame([("1", "1")], "variant_id string, office_id string")
    moves = spark.createDataFrame([(FIRST, None, "1", 5.0, 0.0), (FIRST, "1", None, 5.0, 0.0)], MOVES)
    out = stock.stock_ledger(held, moves, str(FIRST), str(LAST))
    assert out.count() == 20 and out.agg(F.max("stock_final")).collect()[0][0] == 0.0


def test_running_sum_adds_up_a_day_first(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 1, 2.0), ("a", 3, -1.0), ("b", 2, 5.0)], "k string, d int, x double"
    )
    assert rows(running_sum(df, ["k"], "d", F.col("x"), "s")) == [("a", 1, 3.0), ("a", 3, 2.0), ("b", 2, 5.0)]


def test_fill_forward(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 7.0), ("a", 3, None), ("b", 1, None)], "k string, d int, x double"
    )
    assert rows(forward_fill(df, ["k"], "d", "x", "f", 0.0), "k", "d", "f") == [
        ("a", 1, 0.0), ("a", 2, 7.0), ("a", 3, 7.0), ("b", 1, 0.0),
    ]
    assert rows(forward_fill(df, ["k"], "d", "x", "f"), "k", "d", "f")[0] == ("a", 1, None)


def test_movement_lines(spark):
    detail = [((5,), 2.0, 1.5), ((6,), 1.0, 0.5)]
    used = spark.createDataFrame(
        [(1, 1_704_067_200, None, (3, "X"), (detail,)), (2, None, "n", (3, "X"), ([],)), (3, 0, "n", None, None)],
        CONSUMPTION,
    )
    lines = stock.consumption_lines(used)
    assert sorted(tuple(r) for r in lines.collect()) == [
        (1, 1_704_067_200, "", 3, "X", 5, 2.0, 1.5),
        (1, 1_704_067_200, "", 3, "X", 6, 1.0, 0.5),
    ]
    assert stock.stg_consumptions(lines).first().fecha_consumo == dt.date(2024, 1, 1)
    received = spark.createDataFrame([(1, 1_704_067_200, "Guía", None, None, (3, "X"), (detail,))], RECEPTION)
    first = stock.stg_receptions(stock.reception_lines(received)).orderBy("variant_id").first()
    assert (first.document_number, first.note, first.fecha_recibo) == ("", "", dt.date(2024, 1, 1))


def test_stock_rows_with_missing_parts(spark):
    raw = spark.createDataFrame(
        [
            (1, 2.0, 1.0, 1.0, '{"id": 7, "code": "2249AREN00S", "product": {"id": 3}}', '{"id": 1, "name": "X"}'),
            (2, 1.0, 0.0, 1.0, "{}", None),
        ],
        "id bigint, quantity double, quantityReserved double, quantityAvailable double, variant string, office string",
    )
    one, two = stock.stg_stock(raw).orderBy("id").collect()
    assert len(one) == 14
    assert (one.variant_id, one.product_id, one.office_id, one.variant_barcode) == ("7", "3", "1", None)
    assert (two.variant_id, two.office_name) == (None, None)
    groups = spark.createDataFrame(
        [("2249", "g", "c")], "variante_code_desc string, grupo_producto string, categoria string"
    )
    mart = {r.variant_id: r for r in stock.stock_mart(stock.stg_stock(raw), groups).collect()}
    assert (mart["7"].color, mart["7"].grupo_producto, mart[None].color) == ("Arena", "g", "Otro")


def test_stock_repeats_once_per_sale_day(spark):
    held = spark.createDataFrame(
        [("A", "1", 3.0), ("A", "1", 4.0), ("B", "2", 1.0)],
        "variant_code string, variant_id string, quantity double",
    )
    master = spark.createDataFrame([("A", "M")], "sku string, variante string")
    groups = spark.createDataFrame([], "variante_code_desc string, grupo_producto string, categoria string")
    core = spark.createDataFrame(
        [("A", 1, dt.date(2024, 1, 1), 1.0), ("A", 1, dt.date(2024, 1, 1), 2.0), ("A", 1, dt.date(2024, 1, 2), 5.0)],
        "variant_code string, variant_id bigint, fecha_documento date, detail_quantity double",
    )
    out = stock.stock_vs_sales(held, master, groups, core).collect()
    got = sorted((r.variant_id, r.unidades_vendidas or 0, r.stock_actual, r.orden_tallas) for r in out)
    assert got == [("1", 3.0, 7.0, 2), ("1", 5.0, 7.0, 2), ("2", 0, 1.0, None)]


def test_visit_totals(spark):
    day = lambda d, u: (u, dt.datetime(2024, 1, d, 10))
    events = spark.createDataFrame(
        [day(1, 1), day(10, 1), day(10, 1), day(11, 1), day(12, 2), day(2, 3), day(20, 4)],
        "user_id bigint, ts timestamp_ntz",
    )
    out = shop.trailing_visit_totals(events, "2024-01-15", 5).first().asDict()
    assert out == {"total_visits": 4, "total_sessions": 3, "new_visitors": 1, "returning_visitors": 1}
    empty = shop.trailing_visit_totals(events, "2020-01-01").first()
    assert list(empty) == [0, 0, 0, 0]


def test_shop_orders_have_all_columns(spark):
    df = spark.sql("SELECT 5 AS id, array(named_struct('a', 1)) AS line_items, 'x' AS extra")
    row = shop.order_rows(df).first().asDict()
    assert len(row) == 43 and row["line_items"] == '[{"a":1}]'
    assert (row["customer"], row["discount_codes"], row["email"]) == ("{}", "[]", None)


@pytest.mark.parametrize("seed", range(2))
def test_a_ledger_goes_on_from_balances(spark, rows, seed):
    """Pieces of any length, with the balances between them, equal the whole; late pairs have their past."""
    rng = random.Random(seed)
    pairs = [(str(v), str(f)) for v in range(3) for f in range(3) if rng.random() < 0.7]
    moves = spark.createDataFrame(
        [
            (FIRST + dt.timedelta(days=rng.randint(-3, 24)), str(rng.randint(0, 3)), str(rng.randint(0, 2)), rng.random(), rng.random())
            for _ in range(120)
        ]
        + [(FIRST, None, "1", 5.0, 0.0), (None, "1", "1", 5.0, 0.0)],
        MOVES,
    )
    held = spark.createDataFrame(pairs, "variant_id string, office_id string")
    whole = rows(stock.stock_ledger(held, moves, str(FIRST), str(LAST)))
    cuts = [FIRST, FIRST + dt.timedelta(days=1), FIRST + dt.timedelta(days=rng.randint(2, 18)), LAST + dt.timedelta(days=1)]
    got, opening = [], None
    for a, b in zip(cuts, cuts[1:]):
        days = str(a), str(b - dt.timedelta(days=1))
        got += rows(stock.stock_ledger(held, moves, *days, opening))
        opening = stock.closing_balances(moves, *days, opening)
    assert sorted(got) == sorted(whole)


def test_balances_are_kept_for_pairs_that_are_not_in_stock_yet(spark, rows):
    moves = spark.createDataFrame([(FIRST, "9", "1", 4.0, 1.0)], MOVES)
    opening = stock.closing_balances(moves, str(FIRST), str(FIRST))
    held = spark.createDataFrame([("9", "1")], "variant_id string, office_id string")
    late = str(FIRST + dt.timedelta(days=1))
    assert rows(stock.stock_ledger(held, moves, late, late, opening), "stock_final") == [(3.0,)]
    assert rows(stock.stock_ledger(held, moves, late, late), "stock_final") == [(0.0,)]


def test_visits_from_first_days(spark, rows):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    data = [(rng.choice([None, *range(25)]), start + dt.timedelta(hours=rng.randint(0, 24 * 80))) for _ in range(400)]
    events = spark.createDataFrame(data, "user_id int, ts timestamp_ntz")
    for as_of in ("2024-01-05", "2024-02-15", "2024-03-20", "2025-01-01"):
        seen = None
        for a, b in ((0, 30), (20, 45), (40, 81)):  # windows that overlap
            window = events.filter(F.col("ts").between(F.lit(start + dt.timedelta(days=a)), F.lit(start + dt.timedelta(days=b))))
            seen = shop.first_seen(window, seen)
        known = seen.filter(F.col("first_day") <= F.lit(as_of).cast("date"))
        for table in (seen, known):
            assert rows(shop.visit_totals_since(events, table, as_of)) == rows(shop.trailing_visit_totals(events, as_of))
    assert rows(shop.visit_totals_since(events.limit(0), seen, "2024-02-15")) == [(0, 0, 0, 0)]


def test_only_the_window_of_events_is_read(spark):
    from tillmarts.storage import fresh_path

    path = fresh_path(spark, "events")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "user_id int, ts timestamp_ntz").write.parquet(path)
    seen = spark.createDataFrame([], "user int, first_day date")
    plan = shop.visit_totals_since(spark.read.parquet(path), seen, "2024-02-15")._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
