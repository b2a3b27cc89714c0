"""The original tool's six example calls, replayed on a name-only catalog and small tables.

Table choice is metadata only, so the catalog holds names and no data; column
rules run on small DataFrames with the columns the examples name.
"""

import pytest
from pyspark.sql import types as T

from ferry.operators.columns import with_flags, with_source_types
from ferry.plans.catalog import SelectionError, TableRef, select_tables
from ferry.plans.run import TransferOptions, plan_table
from ferry.sources.delimited import FileFormat

# The names of the schemas and tables that the example calls choose from.
NAMES = {
    "HumanResources": ["Department", "Employee", "EmployeeDepartmentHistory", "EmployeePayHistory", "JobCandidate",
                       "Shift"],
    "Person": ["Address", "AddressType", "BusinessEntityAddress", "Person"],
    "Production": ["BillOfMaterials", "Product", "ProductCategory", "ProductCostHistory", "ProductInventory",
                   "ProductListPriceHistory", "ProductModel", "ProductPhoto", "ProductReview", "ProductSubcategory",
                   "TransactionHistory", "WorkOrder", "WorkOrderRouting"],
    "Purchasing": ["ProductVendor", "PurchaseOrderHeader", "ShipMethod", "Vendor"],
    "Sales": ["CountryRegionCurrency", "Customer", "SalesOrderDetail", "SalesOrderHeader", "SalesPerson",
              "SalesTaxRate", "SalesTerritory", "SalesTerritoryHistory"],
}
CATALOG = [TableRef(s, t, "") for s, ts in NAMES.items() for t in ts]
DW = [TableRef("dbo", t, "") for t in ["DimAccount", "DimCustomer", "DimDate", "DimProduct", "FactInternetSales",
                                        "FactResellerSales", "ProspectiveBuyer"]]


def _names(refs):
    return sorted(r.full_name for r in refs)


def test_example_1_wildcards_and_exception_pairs():
    got = select_tables(CATALOG, "HumanResources, Production, Purchasing, Sales",
                        "Product*, *Address, *Tax*, Employee*, Work*", "*", "*History, *Model")
    assert _names(got) == ["HumanResources.Employee", "Production.Product", "Production.ProductCategory",
                           "Production.ProductInventory", "Production.ProductPhoto", "Production.ProductReview",
                           "Production.ProductSubcategory", "Production.WorkOrder", "Production.WorkOrderRouting",
                           "Purchasing.ProductVendor", "Sales.SalesTaxRate"]   # Person.Address: schema not listed


def test_example_1_columns_and_types(spark):
    df = spark.createDataFrame([(1, "a", b"\x00", "<x/>")],
                               "ProductPhotoID int, ThumbnailPhotoFileName string, LargePhoto binary, Notes string")
    df = with_source_types(with_flags(df, identity=["ProductPhotoID"]), {"Notes": "xml"})
    opts = TransferOptions(fmt=FileFormat(header=True), columns_except="LargePhoto", types_except="xml",
                           export_identity=False)
    plan = plan_table(spark, TableRef("Production", "ProductPhoto", ""), opts, df)
    assert plan.error is None and plan.exported.columns == ["ThumbnailPhotoFileName"]


def test_example_2_all_of_a_schema_minus_facts(spark):
    got = select_tables(DW, "dbo", "*", "dbo", "Fact*")
    assert _names(got) == ["dbo.DimAccount", "dbo.DimCustomer", "dbo.DimDate", "dbo.DimProduct",
                           "dbo.ProspectiveBuyer"]
    df = spark.createDataFrame([(1, "x", "y", "z")],
                               "ProductKey int, EnglishDescription string, ArabicDescription string, ArabicName string")
    plan = plan_table(spark, TableRef("dbo", "DimProduct", ""),
                      TransferOptions(fmt=FileFormat(field_delim="^_^", header=True), columns_except="Arabic*"), df)
    assert plan.exported.columns == ["ProductKey", "EnglishDescription"]


def test_example_3_type_exclusion_needs_the_not_null_override(spark):
    got = select_tables(CATALOG, "Sales", "SalesOrderHeader, SalesOrderDetail, SalesPerson")
    assert _names(got) == ["Sales.SalesOrderDetail", "Sales.SalesOrderHeader", "Sales.SalesPerson"]
    schema = T.StructType([T.StructField("BusinessEntityID", T.IntegerType(), False),
                           T.StructField("SalesQuota", T.DecimalType(19, 4)),
                           T.StructField("rowguid", T.StringType(), False)])
    df = with_source_types(spark.createDataFrame([], schema), {"rowguid": "uniqueidentifier"})
    ref = TableRef("Sales", "SalesPerson", "")
    strict = plan_table(spark, ref, TransferOptions(types_except="uniqueidentifier", target="inferred"), df)
    assert "NOT NULL" in strict.error and "rowguid" in strict.error
    ok = plan_table(spark, ref, TransferOptions(types_except="uniqueidentifier", allow_not_null_exceptions=True,
                                                target="inferred"), df)
    assert ok.error is None and ok.exported.columns == ["BusinessEntityID", "SalesQuota"]


def test_example_4_whole_database():
    assert len(select_tables(CATALOG, all_tables=True)) == len(CATALOG)
    with pytest.raises(SelectionError):
        select_tables(CATALOG, "Sales", "*", all_tables=True)


def test_example_5_plain_list():
    got = select_tables(CATALOG, "Production", "TransactionHistory, WorkOrder, BillOfMaterials")
    assert _names(got) == ["Production.BillOfMaterials", "Production.TransactionHistory", "Production.WorkOrder"]


def test_example_6_multi_line_column_list(spark):
    cols = ["ProductKey", "EnglishProductName", "StandardCost", "FinishedGoodsFlag", "Color", "SafetyStockLevel",
            "ReorderPoint", "ListPrice", "Size", "SizeRange", "Weight", "DaysToManufacture", "ProductLine",
            "DealerPrice", "Class", "Style", "ModelName", "LargePhoto"]
    df = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType(), c != "Color") for c in cols]))
    listing = ("StandardCost \r\n      , FinishedGoodsFlag\r\n      , Color\r\n      , SafetyStockLevel\n"
               "      , ReorderPoint, ListPrice, Size, SizeRange, Weight, DaysToManufacture, ProductLine, DealerPrice"
               ", Class, Style, ModelName\r\n      , LargePhoto")
    ref = TableRef("dbo", "DimProduct", "")
    strict = plan_table(spark, ref, TransferOptions(columns_except=listing), df)
    assert strict.error is not None  # NOT NULL columns excluded without the override
    ok = plan_table(spark, ref, TransferOptions(columns_except=listing, allow_not_null_exceptions=True), df)
    assert ok.error is None and ok.exported.columns == ["ProductKey", "EnglishProductName"]


def test_change_script_rows_appended_and_transferred(spark):
    """Two invented rows of a table with many types: inserted, landed and appended to a target."""
    import datetime as dt
    import decimal as dc

    from ferry.operators.relational import insert_values
    from ferry.plans.transfer import import_table, load_into, same_content
    from ferry.session import scratch_path
    from ferry.sources.delimited import write_delimited

    schema = T.StructType([
        T.StructField("BusinessEntityID", T.IntegerType()), T.StructField("TerritoryID", T.IntegerType()),
        T.StructField("SalesQuota", T.DecimalType(19, 4)), T.StructField("Bonus", T.DecimalType(19, 4)),
        T.StructField("CommissionPct", T.DecimalType(10, 4)), T.StructField("SalesYTD", T.DecimalType(19, 4)),
        T.StructField("SalesLastYear", T.DecimalType(19, 4)), T.StructField("rowguid", T.StringType()),
        T.StructField("ModifiedDate", T.TimestampNTZType())])
    base = spark.createDataFrame([], schema)
    d = dc.Decimal
    rows = [(11, 3, d("120500.25"), d("40.00"), d("0.125"), d("7000000.0001"), d("0.5000"),
             "00000000-AAAA-BBBB-CCCC-000000000011", dt.datetime(2021, 2, 28)),
            (12, 3, None, d("0.00"), d("0.0"), d("15.7500"), d("0.0000"),
             "00000000-AAAA-BBBB-CCCC-000000000012", dt.datetime(2021, 3, 1, 23, 59, 59, 999000))]
    sales_person = insert_values(spark, base, rows)
    fmt = FileFormat(header=True)
    landing, target = scratch_path(spark, "sp-land"), scratch_path(spark, "sp-target")
    assert write_delimited(sales_person, landing, fmt) == 2
    res = load_into(import_table(spark, landing, fmt, schema), target, mode="append")
    assert res.rows == 2 and res.error is None
    back = spark.read.parquet(target)
    assert back.schema == schema and same_content(sales_person, back)
