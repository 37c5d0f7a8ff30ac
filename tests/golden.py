"""Our own rows for the seven-order scenario of FIXTURES.md, section 2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.sources.landing import RAW_SCHEMAS

BATCH = "fixture_batch"
PEOPLE = [
    ("shared", 10001, "city_a", "SP"), ("shared", 20002, "city_b", "RJ"), ("third", 30003, "city_c", "MG"),
    ("fourth", 40004, "city_d", "SP"), ("fifth", 50005, "city_e", "BA"), ("sixth", 60006, "city_f", "SP"),
    ("seventh", 70007, "city_g", "RJ"),
]
ITEMS = [
    (1, 1, "P1", "S1", "100.00", "10.00"), (1, 2, "P2", "S2", "50.00", "5.00"), (2, 1, "P1", "S1", "20.00", "2.00"),
    (3, 1, "P2", "S2", "30.00", "3.00"), (4, 1, "P1", "S1", "40.00", "4.00"), (5, 1, "P2", "S2", "50.00", "5.00"),
    (7, 1, "P1", "S1", "70.00", "7.00"),
]
PAID = {1: "165.00", 2: "22.01", 3: "40.00", 4: "40.00", 6: "12.00", 7: "77.00"}


def golden_rows() -> dict[str, list[tuple]]:
    orders = [
        (f"O{i}", f"C{i}", "delivered" if i <= 4 else "canceled", f"2025-{i:02d}-01 10:00:00",
         f"2025-{i:02d}-01 11:00:00", f"2025-{i:02d}-06 12:00:00" if i <= 4 else None,
         f"2025-{i:02d}-09 12:00:00" if i <= 4 else None, f"2025-{i:02d}-15 12:00:00")
        for i in range(1, 8)
    ]
    return {
        "customers": [(f"C{i}", *p) for i, p in enumerate(PEOPLE, 1)],
        "geolocation": [(10001, -23.5, -46.6, "city_a", "SP"), (10001, -23.5, -46.6, "city_a", "SP")],
        "order_items": [
            (f"O{o}", n, p, s, f"2025-{o:02d}-05 12:00:00", price, freight) for o, n, p, s, price, freight in ITEMS
        ],
        "orders": orders,
        "payments": [(f"O{i}", 1, "card", 1, v) for i, v in PAID.items()],
        "products": [("P1", "livros", *[10.5] * 7), ("P2", "brinquedos", *[11.5] * 7)],
        "reviews": [("R1", "O1", 5, "good", "fine", "2025-01-10 12:00:00", "2025-01-11 12:00:00")],
        "sellers": [("S1", 10001, "city_a", "SP"), ("S2", 20002, "city_b", "RJ")],
        "translation": [("livros", "books"), ("brinquedos", "toys")],
    }


def golden_raw(spark, rows=None):
    out = {}
    for entity, listed in (rows or golden_rows()).items():
        text = RAW_SCHEMAS[entity].replace("decimal(18,2)", "string")
        df = spark.createDataFrame(
            [(*r, i) for i, r in enumerate(listed, 1)], f"{text}, _file_row_number bigint"
        )
        out[entity] = df.withColumns({
            "_source_file": F.lit(f"{entity}.csv"),
            "_loaded_at": F.lit("2026-01-01 00:00:00").cast("timestamp"),
            "_batch_id": F.lit(BATCH),
        })
    return out
