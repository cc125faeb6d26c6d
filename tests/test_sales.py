"""Documents to sales marts on hand-made documents."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmarts.plans import sales
from tillmarts.plans.calendar import date_table

DOCUMENT = (
    "id bigint, emissionDate bigint, expirationDate bigint, generationDate bigint, number bigint,"
    "totalAmount double, netAmount double, taxAmount double, document_type string, client string,"
    "office string, user string, references string, details string"
)
DAY = 86_400
D0 = 19_723 * DAY  # 2024-01-01


def line(code="2249AREN00S", variant=1, quantity=2, net=10.0, size="S", **extra):
    return {
        "id": 1, "lineNumber": 1, "quantity": quantity, "netUnitValue": net, "totalUnitValue": net,
        "netAmount": net * quantity, "taxAmount": 1.0, "totalAmount": net * quantity + 1,
        "netDiscount": 0, "totalDiscount": 0, "note": "n", "relatedDetailId": 0,
        "variant": {"id": variant, "description": size, "code": code}, **extra,
    }


def document(id, details, references="[]", type=1, day=0, office=1):
    if isinstance(details, list):
        details = json.dumps({"items": details})
    when = D0 + day * DAY
    return (
        id, when, when, when, 100 + id, 50.0, 40.0, 10.0, json.dumps({"id": type}), '{"id": 7}',
        json.dumps({"id": office}), '{"id": 3}', references, details,
    )


def documents(spark, *rows):
    return spark.createDataFrame(list(rows), DOCUMENT)


def types(spark):
    rows = [
        (1, "BOLETA ELECTRÓNICA T", "39"),
        (9, "NOTA DE CRÉDITO ELECTRÓNICA T", "61"),
        (22, "GUÍA DE DESPACHO", "52"),
    ]
    return spark.createDataFrame(rows, "id bigint, name string, codeSii string")


TWO_REFERENCES = '[{"id": 1, "reason": "a"}, {"id": 2, "reason": "b"}]'


def test_shapes_of_details_and_references(spark):
    docs = documents(
        spark,
        document(1, [line(), line(), line()], TWO_REFERENCES),
        document(2, json.dumps([line()]), '{"href": "x"}'),
        document(3, "{}"),
        document(4, "[]"),
        document(5, None),
        document(6, '{"items": []}', TWO_REFERENCES),
        document(7, [line()], None),
    )
    raw = sales.raw_document(docs)
    counts = {r.doc_id: r["count"] for r in raw.groupBy("doc_id").count().collect()}
    assert counts == {1: 6, 2: 1, 7: 1}
    assert {r.reference_id for r in raw.filter("doc_id = 1").collect()} == {1, 2}
    one = raw.filter("doc_id = 7").collect()[0]
    assert (one.document_type_id, one.client_id, one.office_id, one.user_id) == (1, 7, 1, 3)
    assert (one.detail_quantity, one.variant_code, one.reference_id) == (2.0, "2249AREN00S", None)


def test_a_bad_value_spoils_only_itself(spark):
    bad = line() | {"quantity": "many", "lineNumber": "3", "netUnitValue": "x"}
    row = sales.raw_document(documents(spark, document(1, json.dumps({"items": [bad]})))).collect()[0]
    assert row.detail_quantity is None and row.detail_netUnitValue is None
    assert (row.detail_lineNumber, row.detail_netAmount) == (3, 20.0)


def test_second_explode_equals_the_join_for_unique_documents(spark, rows):
    docs = documents(
        spark,
        document(1, [line(), line(variant=2)], TWO_REFERENCES),
        document(2, [line()], "[]"),
        document(3, "{}", TWO_REFERENCES),
    )
    assert rows(sales.raw_document(docs)) == rows(sales.raw_document(docs, unique_ids=False))


def test_join_multiplies_documents_loaded_twice(spark):
    docs = documents(spark, document(1, [line()], TWO_REFERENCES), document(1, [line()], TWO_REFERENCES))
    assert sales.raw_document(docs).count() == 4
    assert sales.raw_document(docs, unique_ids=False).count() == 8


@pytest.fixture(scope="module")
def core(spark):
    docs = documents(
        spark,
        # Day 0: three sale lines, one of them a credit note, plus a non-sale and an unnamed type.
        document(1, [line(), line(code="2249BLANBLAM", variant=2, size="U")]),
        document(2, [line(quantity=1)], type=9),
        document(3, [line()], type=22),
        document(4, [line(code=None, variant=None)], type=77, office=9),
        # Day 1: one sale line. Day 2: only a non-sale. Day 3: a sale without spend.
        document(5, [line(code="9999ZZZZ", variant=9)], day=1),
        document(6, [line()], type=22, day=2),
        document(7, [line()], day=3),
        # Outside the calendar.
        document(8, [line()], day=2_000),
    )
    ads = spark.createDataFrame(
        [("2024-01-01", 60.0), ("2024-01-01", 30.0), ("2024-01-02", 40.0), ("2024-01-03", 5.0)],
        "date_start string, spend double",
    ).withColumn("date_start", F.to_date("date_start"))
    master = spark.createDataFrame(
        [("2249AREN00S", "camisa", "Camisa Arena", "S", 4.0, 9.0)],
        "sku string, tipo_producto string, nombre_producto string, variante string,"
        "costo_neto double, precio_unitario double",
    )
    groups = sales.product_groups(
        spark.createDataFrame(
            [(2249, "Camisas", "Ropa")],
            "int64_field_0 bigint, string_field_1 string, string_field_2 string",
        )
    )
    stock = spark.createDataFrame(
        [("1", 5.0), ("1", 6.0), ("2", 1.0)], "variant_id string, quantity double"
    )
    lines = sales.stg_document_lines(sales.raw_document(docs), types(spark))
    frames = dict(ads=ads, master=master, groups=groups, stock=stock, lines=lines)
    result = sales.sales_core(lines, ads, master, groups, stock, date_table(spark)).cache()
    return result, frames


def by_doc(core, doc):
    return core[0].filter(F.col("doc_id") == doc).collect()


def test_spend_is_shared_by_the_sale_lines_of_the_day(core):
    assert [r.inversion_desglosada_fbads for r in by_doc(core, 1)] == [30.0, 30.0]
    assert by_doc(core, 2)[0].inversion_desglosada_fbads == 30.0
    assert by_doc(core, 3)[0].inversion_desglosada_fbads == 0.0  # not a sale
    assert by_doc(core, 4)[0].inversion_desglosada_fbads == 30.0  # type without a name
    assert by_doc(core, 5)[0].inversion_desglosada_fbads == 40.0  # only sale line of the day
    assert by_doc(core, 6)[0].inversion_desglosada_fbads == 0.0
    assert by_doc(core, 7)[0].inversion_desglosada_fbads is None  # no spend that day


def test_shares_add_up_to_the_spend_of_days_with_sales(core):
    sale = core[0].filter(F.col("document_name").rlike("^(BOLETA|NOTA DE CR)"))
    totals = sale.groupBy("fecha_documento").agg(F.sum("inversion_desglosada_fbads").alias("s")).collect()
    assert {str(r.fecha_documento): r.s for r in totals if r.s is not None} == {
        "2024-01-01": 90.0, "2024-01-02": 40.0,
    }


def test_credit_notes_are_negative(core):
    note = by_doc(core, 2)[0]
    assert (note.detail_quantity, note.total_amount, note.costo_neto, note.precio_unitario) == (-1, -50, -4, -9)
    assert by_doc(core, 1)[0].total_amount == 50


def test_attributes_and_their_absence(core):
    arena, white = sorted(by_doc(core, 1), key=lambda r: r.variant_id)
    assert (arena.color, arena.tipo_producto, arena.grupo_producto, arena.orden_tallas) == (
        "Arena", "camisa", "Camisas", 1,
    )
    assert (arena.stock_actual, arena.office, arena.month_name) == (11.0, "PROVIDENCIA", "Enero")
    assert (white.color, white.tipo_producto, white.orden_tallas, white.stock_actual) == ("Blanco", None, None, 1.0)
    nothing = by_doc(core, 4)[0]
    assert (nothing.color, nothing.grupo_producto, nothing.stock_actual) == ("Otro", None, None)
    assert (nothing.document_name, nothing.office) == (None, "OTRA OFICINA")
    assert by_doc(core, 8)[0].year is None and by_doc(core, 5)[0].color == "Otro"


def test_repeated_master_entries_repeat_lines(spark, core):
    _, f = core
    doubled = f["master"].unionByName(f["master"].withColumn("tipo_producto", F.lit("otra")))
    again = sales.sales_core(f["lines"], f["ads"], doubled, f["groups"], f["stock"], date_table(spark))
    with_master = core[0].filter("tipo_producto IS NOT NULL").count()
    assert again.count() == core[0].count() + with_master


def test_daily_sales_count_sales_only(core):
    daily = sales.sales_daily(core[0]).collect()
    assert {str(r.fecha) for r in daily} == {"2024-01-01", "2024-01-02", "2024-01-04", "2029-06-23"}
    first = [r for r in daily if str(r.fecha) == "2024-01-01" and r.variant_id == 1][0]
    assert (first.unidades_vendidas, first.venta_neta, first.precio_unitario) == (1.0, 10.0, 9.0)


def test_sums_are_exact(spark):
    df = spark.createDataFrame([(Decimal(1) / 10,)] * 10, "x decimal(3,1)").select(F.col("x").cast("double"))
    from tillmarts.functions.numbers import money_sum

    assert df.agg(money_sum(F.col("x"))).collect()[0][0] == 1.0
