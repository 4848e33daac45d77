import pytest
from pyspark.sql import functions as F

from mercata.functions.naming import clean_name, clean_name_col, clean_names

CASES = ["  Order Date ", "Sub-Category", "Country/Region", "Sales (USD)", "\tTAB ", "Ship-Mode (x) y",
         "already_clean", "", "  ", "Ünïcode Name"]


def test_python_rule():
    assert clean_name("  Order Date ") == "order_date"
    assert clean_name("Sub-Category") == "sub_category"
    assert clean_name("Country/Region") == "country/region"
    assert clean_name("Sales (USD)") == "sales_usd"


def test_column_form_matches_driver_form(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "name string")
    got = [r[0] for r in df.select(clean_name_col(F.col("name"))).collect()]
    assert got == [clean_name(c) for c in CASES]


def test_collisions_are_rejected():
    with pytest.raises(ValueError, match="both clean to 'a_b'"):
        clean_names(["A b", "a-b"])
    assert clean_names(["A", "B"]) == ["a", "b"]
