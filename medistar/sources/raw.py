"""SRC-4..SRC-10: scans of the retail warehouse tables.

The reader is pluggable (``parquet`` folder or any ``spark.read.format``
source such as ``jdbc``); each scan is a projection (plus the one filter on the
product table) that Catalyst pushes into the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# SRC-4 geography, SRC-5 territory, SRC-6 category + subcategory, SRC-7 product (ListPrice filter),
# SRC-8 customer (FullName = first + last), SRC-9 internet sales, SRC-10 product inventory
SOURCE_SCANS = {
    "dim_geography": ("DimGeography", ["GeographyKey", "City", "StateProvinceName",
                                       ("EnglishCountryRegionName", "CountryRegion"), "PostalCode",
                                       "SalesTerritoryKey"], None),
    "dim_sales_territory": ("DimSalesTerritory", ["SalesTerritoryKey", ("SalesTerritoryRegion", "TerritoryName"),
                                                  ("SalesTerritoryCountry", "TerritoryCountry"),
                                                  ("SalesTerritoryGroup", "TerritoryGroup")], None),
    "dim_product_category": ("DimProductCategory", ["ProductCategoryKey",
                                                    ("EnglishProductCategoryName", "CategoryName")], None),
    "dim_product_subcategory": ("DimProductSubcategory", ["ProductSubcategoryKey", "ProductCategoryKey",
                                                          ("EnglishProductSubcategoryName", "SubcategoryName")], None),
    "dim_product": ("DimProduct", ["ProductKey", "ProductAlternateKey", ("EnglishProductName", "ProductName"),
                                   "Color", "Size", "ListPrice", "StandardCost", "DealerPrice",
                                   "ProductSubcategoryKey", "Status", "FinishedGoodsFlag", "ProductLine"],
                    "ListPrice IS NOT NULL"),
    "dim_customer": ("DimCustomer", ["CustomerKey", "FirstName", "LastName", "EmailAddress", "Phone",
                                     "GeographyKey"], None),
    "fact_internet_sales": ("FactInternetSales", ["SalesOrderNumber", "SalesOrderLineNumber", "ProductKey",
                                                  "CustomerKey", "SalesTerritoryKey", "OrderDateKey", "ShipDateKey",
                                                  "DueDateKey", "OrderQuantity", "UnitPrice", "UnitPriceDiscountPct",
                                                  "ExtendedAmount", "TotalProductCost", "SalesAmount", "TaxAmt",
                                                  "Freight"], None),
    "fact_product_inventory": ("FactProductInventory", ["ProductKey", "DateKey", "UnitsBalance", "UnitCost",
                                                        "MovementDate"], None),
}


def read_source(spark: SparkSession, table: str, fmt: str = "parquet", path: str | None = None,
                options: dict | None = None) -> DataFrame:
    """Read one source table: ``parquet`` from ``{path}/{table}`` or any format with options
    (for ``jdbc`` pass ``url``, ``user``, ``password``; ``dbtable`` defaults to the table name)."""
    opts = dict(options or {})
    if fmt == "parquet":
        return spark.read.options(**opts).parquet(f"{path.rstrip('/')}/{table}")
    if fmt == "jdbc":
        opts.setdefault("dbtable", table)
    r = spark.read.format(fmt).options(**opts)
    return r.load(path) if path else r.load()


def scan(spark: SparkSession, name: str, **reader) -> DataFrame:
    """Projection (and filter) of one source table, named like the star's raw inputs."""
    table, cols, where = SOURCE_SCANS[name]
    df = read_source(spark, table, **reader)
    sel = [F.col(c) if isinstance(c, str) else F.col(c[0]).alias(c[1]) for c in cols]
    out = df.select(*sel)
    if where:
        out = out.where(where)
    if name == "dim_customer":
        out = out.withColumn("FullName", F.concat_ws(" ", "FirstName", "LastName"))
    return out


def extract_sources(spark: SparkSession, **reader) -> dict[str, DataFrame]:
    return {name: scan(spark, name, **reader) for name in SOURCE_SCANS}
