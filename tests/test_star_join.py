"""The published star: which joins come first, and its rows."""

from datetime import date
from types import SimpleNamespace

from lakeward.plans import queries


def _star(spark, monkeypatch):
    tables = {
        "az_order_details": spark.createDataFrame(
            [(1, 1, 7, 1.5), (1, 2, 8, 2.5), (1, 2, 8, 2.5), (2, 1, None, 3.5), (3, 1, 7, 4.5), (None, 1, 7, 5.5)],
            "sales_order_id int, sales_order_detail_id int, product_id int, line_total double"),
        "az_order_headers": spark.createDataFrame(
            [(1, "a", date(2024, 1, 1)), (2, "z", date(2024, 1, 2)), (4, "a", None), (None, "a", None)],
            "sales_order_id int, customer_sk string, order_date date"),
        "az_products": spark.createDataFrame([(7, "seven"), (9, "nine"), (None, "none")], "product_id int, product_name string"),
        "az_customers": spark.createDataFrame([("a", "AW1"), ("b", "AW2"), ("a", "AW3")], "customer_sk string, account_number string"),
    }
    written = []
    p = SimpleNamespace(spark=spark, run=lambda day: SimpleNamespace(ref=tables.__getitem__),
                        write_source=lambda table, folder: written.append(table))
    monkeypatch.setattr(queries, "_pipe", lambda *_: p)
    return queries.star_join(spark, "none"), written


def test_rows_of_the_star(spark, monkeypatch):
    star, written = _star(spark, monkeypatch)
    day = date(2024, 1, 1)
    expected = [(1, n, day, "a", account, product, name, total) for n, product, name, total, times in
                ((1, 7, "seven", 1.5, 1), (2, 8, None, 2.5, 2)) for account in ("AW1", "AW3") for _ in range(times)]
    expected.append((2, 1, date(2024, 1, 2), "z", None, None, None, 3.5))
    assert sorted(map(tuple, star.collect()), key=str) == sorted(expected, key=str)
    assert written == ["sales_order_detail"]  # numbered once for both days


def test_lines_are_not_shuffled_with_what_headers_and_customers_add(spark, monkeypatch):
    star, _ = _star(spark, monkeypatch)
    plan = star._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in plan if "Join" in line]
    assert len(joins) == 3 and "Join Inner" in joins[0] and "sales_order_id" in joins[0]
    assert all("Join LeftOuter" in j for j in joins[1:])
