"""End to end: landing folder -> raw -> star -> reporting databases, plus the audits."""

import datetime as dt
import os

from mercata.operators.quality import health_check, layer_row_counts
from mercata.plans.layers import Layers, run_all
from xlsx_writer import write_xlsx

HEADER = ["Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name", "Segment",
          "Country/Region", "City", "State/Province", "Postal Code", "Region", "Product ID", "Category",
          "Sub-Category", "Product Name", "Sales", "Quantity", "Discount", "Profit"]


def _line(i, order, cust, prod, sales, profit, day):
    return [i, order, day, day + dt.timedelta(days=3), "Second Class", cust, f"Name {cust}", "Consumer",
            "United States", "Henderson", "Kentucky", "42420", "South", prod, "Furniture", "Chairs",
            f"Chair {prod}", sales, 2, 0.2, profit]


def test_run_all_layers(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    lines = [_line(1, "CA-1", "C-1", "P-1", 261.96, 41.91, dt.date(2021, 11, 8)),
             _line(2, "CA-1", "C-1", "P-2", 731.94, 219.58, dt.date(2021, 11, 8)),
             _line(3, "CA-2", "C-2", "P-1", 14.62, 6.87, dt.date(2022, 6, 12))]
    write_xlsx(os.path.join(land, "Retail Sample.xlsx"), {
        "Orders": [HEADER, *lines],
        "People": [["Regional Manager", "Region"], ["Chuck", "South"]],
        "Returns": [["Returned", "Order ID"], ["Yes", "CA-1"]],
    })
    layers = Layers(raw="t_raw_layer", star="t_star_layer", reporting="t_reporting_layer")
    out = run_all(spark, land, layers)
    assert {r.table for r in out["bronze"]} == {"orders", "people", "returns"}
    assert out["silver"]["fact_sales"] == 3 and out["silver"]["fact_returns"] == 2
    counts = {r["table_name"]: (r["table_kind"], r["row_count"]) for r in layer_row_counts(spark, layers.star).collect()}
    assert counts["dim_customer"] == ("DIMENSION", 2) and counts["fact_returns"] == ("FACT", 2)
    spark.range(3).createOrReplaceTempView("scratch_view")  # temp views are not layer tables
    assert len(layer_row_counts(spark, layers.reporting).collect()) == 7
    ltv = {r["customer_id"]: r for r in spark.table(f"{layers.reporting}.agg_customer_lifetime_value").collect()}
    assert ltv["C-1"]["total_returns"] == 1 and ltv["C-1"]["ltv_tier"] == "Silver"
    assert health_check(spark, layers.reporting).first()["healthy"] is True
    bad = health_check(spark, "no_such_layer").first()
    assert bad["healthy"] is False and bad["error"]


def test_cli_runs_all_layers(spark, tmp_dir, capsys):
    import json

    from mercata.__main__ import main

    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    write_xlsx(os.path.join(land, "Retail Sample.xlsx"), {
        "Orders": [HEADER, _line(1, "CA-9", "C-9", "P-9", 20.0, 5.0, dt.date(2022, 3, 1))],
        "People": [["Regional Manager", "Region"], ["Chuck", "South"]],
        "Returns": [["Returned", "Order ID"], ["Yes", "CA-9"]],
    })
    main(["--landing", land, "--raw", "c_raw", "--star", "c_star", "--reporting", "c_rep", "--on-duplicate", "first"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["silver"]["fact_sales"] == 1 and out["gold"]["agg_monthly_sales"] == 1
    assert all(v["healthy"] for v in out["health"].values())


def test_csv_landed_orders_build_the_star(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "Orders.csv"), "w") as f:
        f.write(",".join(HEADER) + "\n")
        for ln in [_line(1, "CA-1", "C-1", "P-1", 10.5, 2.5, dt.date(2021, 5, 1)),
                   _line(2, "CA-2", "C-2", "P-1", 4.0, -1.0, dt.date(2021, 6, 1))]:
            f.write(",".join(str(v) for v in ln) + "\n")
    with open(os.path.join(land, "People.csv"), "w") as f:
        f.write("Regional Manager,Region\nChuck,South\n")
    with open(os.path.join(land, "Returns.csv"), "w") as f:
        f.write("Returned,Order ID\nYes,CA-2\n")
    layers = Layers(raw="t_csv_raw", star="t_csv_star", reporting="t_csv_rep")
    out = run_all(spark, land, layers, overrides={"orders": {"Postal Code": "string"}})
    assert out["silver"]["fact_sales"] == 2 and out["silver"]["fact_returns"] == 1
    geo = spark.table(f"{layers.star}.dim_geography").first()
    assert geo["postal_code"] == "42420" and geo["country"] == "United States"
