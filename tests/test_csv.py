"""CSV inputs: columns by name, missing-value texts, whole numbers, bad cells."""
import pytest

from conftest import SF_SMALL  # noqa: F401
from shelfwise.schema import INVENTORY_CSV_SCHEMA, SALES_SCHEMA
from shelfwise.sources import files

SALES = dict(Sale_Date="2024-02-03", Region="East", Product_Category="Toys", Sales_Amount="10.5", Quantity_Sold="2.0", Unit_Cost="3",
             Unit_Price="5.25", Discount="0.1", Product_ID="P1", Customer_Type="New", Sales_Channel="Online")


def _write(tmp_path, rows, name="in.csv"):
    path = tmp_path / name
    path.write_text("\n".join([",".join(rows[0])] + [",".join(r.values()) for r in rows]) + "\n", encoding="utf-8")
    return str(path)


def test_shuffled_and_extra_columns(spark, tmp_path):
    row = {"Extra": "x", **dict(reversed(SALES.items())), "Another": "7"}
    got = files.read_sales_csv(spark, _write(tmp_path, [row])).first().asDict()
    assert list(got) == [f.name for f in SALES_SCHEMA.fields]
    assert str(got["Sale_Date"]) == "2024-02-03" and got["Region"] == "East" and got["Quantity_Sold"] == 2
    assert got["Sales_Amount"] == 10.5 and got["Sales_Channel"] == "Online"


def test_inventory_by_name(spark, tmp_path):
    values = {f.name: "1" for f in INVENTORY_CSV_SCHEMA.fields} | {"Date": "2024-01-01", "Region": "East", "Price": "9.5"}
    row = {"Store ID": "S1", "Product ID": "P1", **dict(reversed(values.items()))}
    got = files.read_inventory_csv(spark, _write(tmp_path, [row])).first()
    assert got.Region == "East" and got.Price == 9.5 and got.Holiday_Promotion == 1 and got.Inventory_Level == 1.0


def test_missing_texts_are_null(spark, tmp_path):
    rows = [SALES | {"Region": t, "Unit_Cost": t, "Quantity_Sold": t} for t in ("NA", "N/A", "null", "NaN", "", "nan", "None")]
    got = files.read_sales_csv(spark, _write(tmp_path, rows)).collect()
    assert len(got) == 7 and all(r.Region is None and r.Unit_Cost is None and r.Quantity_Sold is None for r in got)


@pytest.mark.parametrize("column, cell", [("Sale_Date", "03/02/2024"), ("Quantity_Sold", "2.5"), ("Quantity_Sold", "two"), ("Unit_Cost", "1,5x"[:1] + "x")])
def test_bad_cells_raise_or_are_counted(spark, tmp_path, column, cell):
    path = _write(tmp_path, [SALES, SALES | {column: cell}, SALES | {column: cell}])
    with pytest.raises(Exception, match=f"column {column} cannot take '{cell}'"):
        files.read_sales_csv(spark, path).collect()
    assert [r[column] for r in files.read_sales_csv(spark, path, on_bad="null").collect()].count(None) == 2
    assert [tuple(r) for r in files.rejected_cells(spark, path, SALES_SCHEMA).collect()] == [(column, 2, cell)]


def test_missing_column_is_named(spark, tmp_path):
    row = {k: v for k, v in SALES.items() if k not in ("Region", "Discount")}
    with pytest.raises(files.ContractError, match="Region, Discount"):
        files.read_sales_csv(spark, _write(tmp_path, [row]))


def test_files_of_other_order_are_refused(spark, tmp_path):
    d = tmp_path / "d"
    d.mkdir()
    _write(d, [SALES], "a.csv")
    _write(d, [dict(reversed(SALES.items()))], "b.csv")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_sales_csv(spark, str(d)).collect()


def test_predictions_get_their_month_parts(spark, tmp_path):
    out = str(tmp_path)
    for name in files.REPORT_NAMES:
        files.write_table(spark.createDataFrame([("2024-03-01", "East", 1.5)], "Month string, Region string, Net_Profit double"),
                          f"{out}/{name}", "csv")
    preds = files.load_reports(spark, out, "csv")["predictions"].first()
    assert (str(preds.Month), preds.Year, preds.MonthNum, preds.MonthLabel, preds.Net_Profit) == ("2024-03-01", 2024, 3, "Mar 2024", 1.5)


@pytest.mark.parametrize("cell", ["2022-01-15xyz", "2022-01-155", "2022-01-15 25:00", "2022-02-30", "22-01-15", "2022-01-15 10:00 x"])
def test_a_date_is_the_whole_cell(spark, tmp_path, cell):
    path = _write(tmp_path, [SALES | {"Sale_Date": cell}])
    with pytest.raises(Exception, match="column Sale_Date cannot take"):
        files.read_sales_csv(spark, path).collect()
    assert files.read_sales_csv(spark, path, on_bad="null").first().Sale_Date is None


def test_dates_with_a_time_of_day(spark, tmp_path):
    cells = ["2022-01-15", " 2022-01-15 ", "2022-01-15 23:59:59", "2022-01-15T10:00", "2022-01-15 00:00:00.123"]
    got = files.read_sales_csv(spark, _write(tmp_path, [SALES | {"Sale_Date": c} for c in cells])).collect()
    assert {str(r.Sale_Date) for r in got} == {"2022-01-15"} and len(got) == len(cells)


def test_texts_are_kept_as_delivered(spark, tmp_path):
    """Blanks are part of a text, not of a number; a missing-value text with blanks is a text."""
    rows = [SALES | {"Region": r, "Unit_Cost": " 3 "} for r in (" East", "East", "East ", " NA")]
    got = files.read_sales_csv(spark, _write(tmp_path, rows)).collect()
    assert [r.Region for r in got] == [" East", "East", "East ", " NA"] and {r.Unit_Cost for r in got} == {3.0}
