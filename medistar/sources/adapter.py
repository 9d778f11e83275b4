"""Adapter from the driver's TPC-H-style tables to the raw source shapes the
star job reads (a retail warehouse: geography, territory, product
category/subcategory, product, customer, internet sales, product inventory).

The driver data is clean, so fixed modulo rules add the dirt that exercises
every cleansing rule.  Money is produced as DECIMAL(18,4), as a warehouse
would store it.  All of it is column expressions and equi-joins; the
inventory source is pre-aggregated per (part, month) before it meets ``part``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.sources.raw import SOURCE_SCANS

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# FIXED VALUES of the adapter (test-data mapping)
COUNTRIES = ["United States", "Canada", "France", "Germany", "United Kingdom",
             "Australia", "India", "Brazil", None]
CATEGORIES = [(1, "Bikes"), (2, "Components"), (3, "Clothing"), (4, "Accessories"), (5, "Other")]
SUBCATEGORIES = [
    (1, 1, "Mountain Bikes"), (2, 1, "Road Bikes"), (3, 1, "Touring Bikes"),
    (4, 2, "Handlebars"), (5, 2, "Bottom Brackets"), (6, 2, "Brakes"),
    (7, 3, "Jerseys"), (8, 3, "Shorts"), (9, 3, "Vests"),
    (10, 4, "Helmets"), (11, 4, "Hydration Packs"), (12, 4, "Tires and Tubes"),
    (13, 2, "Pedals"), (14, 2, "Saddles"), (15, 2, "Wheels"),
    (16, 3, "Gloves"), (17, 3, "Socks"), (18, 3, "Caps"),
    (19, 4, "Fenders"), (20, 4, "Locks"), (21, 4, "Panniers"), (22, 4, "Pumps"), (23, 4, "Lights"),
    (24, 5, "General Care"), (25, 5, "Extras"),
]
COLORS = ["Blue", "Red", "Black", "White", "Yellow", "Silver", "Grey", "Multi", "NA"]
# END FIXED VALUES


def read_driver_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _pick(values, idx) -> DataFrame:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (idx % len(values)).cast("int") + 1)


def _dec(c):
    return X.money(c)


def geography(t) -> DataFrame:
    n = t["nation"]
    r = t["region"]
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
            .select((F.col("n_nationkey") + 1).cast("long").alias("GeographyKey"),
                    F.col("n_name").alias("City"),
                    F.col("r_name").alias("StateProvinceName"),
                    _pick(COUNTRIES, F.col("n_nationkey")).alias("CountryRegion"),
                    F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("PostalCode"),
                    (F.col("n_regionkey") + 1).cast("long").alias("SalesTerritoryKey")))


def territory(t) -> DataFrame:
    return t["region"].select(
        (F.col("r_regionkey") + 1).cast("long").alias("SalesTerritoryKey"),
        F.col("r_name").alias("TerritoryName"),
        F.col("r_name").alias("TerritoryCountry"),
        F.concat(F.lit("Group "), (F.col("r_regionkey") % 2).cast("string")).alias("TerritoryGroup"))


def category(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "ProductCategoryKey int, CategoryName string")


def subcategory(spark: SparkSession, t: dict[str, DataFrame] | None = None) -> DataFrame:
    """The subcategories that parts belong to (without tables: all), with their fixed names."""
    named = spark.createDataFrame(
        SUBCATEGORIES, "ProductSubcategoryKey int, ProductCategoryKey int, SubcategoryName string")
    if t is None:
        return named
    used = t["part"].select(_subcategory_key().alias("ProductSubcategoryKey")).distinct()
    return used.join(F.broadcast(named), "ProductSubcategoryKey")  # 25 names


def _subcategory_key():
    return F.regexp_extract(F.col("p_brand"), r"(\d+)", 1).cast("int")


def product(t) -> DataFrame:
    p = t["part"]
    k = F.col("p_partkey")
    price = _dec("p_retailprice")
    size = F.col("p_size")
    size_code = (F.when(size <= 10, "S").when(size <= 20, "M").when(size <= 30, "L")
                 .when(size <= 37, "XL").otherwise(size.cast("string")))
    return p.select(
        (k.cast("long") + 1).alias("ProductKey"),
        F.concat(F.lit("PRD-"), k.cast("string")).alias("ProductAlternateKey"),
        F.when(k % 211 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("ProductName"),
        _pick(COLORS, k).alias("Color"),
        size_code.alias("Size"),
        F.when(k % 97 == 0, F.lit(0).cast(X.MONEY)).otherwise(price).alias("ListPrice"),
        _dec(F.when(k % 89 == 0, price * F.lit(Decimal("3.6"))).otherwise(price * F.lit(Decimal("0.6")))).alias("StandardCost"),
        _dec(F.when(k % 83 == 0, F.lit(0)).otherwise(price * F.lit(Decimal("0.8")))).alias("DealerPrice"),
        _subcategory_key().alias("ProductSubcategoryKey"),
        F.when(k % 10 == 0, "0").otherwise("Current").alias("Status"),
        F.lit(True).alias("FinishedGoodsFlag"),
        F.col("p_type").alias("ProductLine"))


def _initcap_word(c):
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.expr(f"substring({c}, 2)")))


def customer(t) -> DataFrame:
    c = t["customer"]
    k = F.col("c_custkey")
    ck = k.cast("long") * 17 + 1
    gone = k % 101 == 0
    first = F.when(gone, F.lit(None).cast("string")).otherwise(_initcap_word("c_mktsegment"))
    last = F.when(gone, F.lit(None).cast("string")).otherwise(F.col("c_name"))
    email = (F.when(k % 19 == 0, F.lit(None).cast("string"))
             .when(k % 17 == 0, F.concat(F.lower("c_name"), F.lit("example.com")))
             .otherwise(F.concat(F.lower("c_name"), F.lit("@example.com"))))
    phone = F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("555-"), ck.cast("string")))
    return c.select(ck.alias("CustomerKey"), first.alias("FirstName"), last.alias("LastName"),
                    F.concat_ws(" ", first, last).alias("FullName"),
                    email.alias("EmailAddress"), phone.alias("Phone"),
                    (F.col("c_nationkey") + 1).cast("long").alias("GeographyKey"))


# columns that give the sales source a total row order (first-row-wins dedupe)
SALES_ORDER_COLS = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def internet_sales(t) -> DataFrame:
    li = t["lineitem"]
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    c = t["customer"].select("c_custkey", "c_nationkey")
    n = t["nation"].select("n_nationkey", "n_regionkey")
    p = t["part"].select("p_partkey", "p_retailprice")
    # order header enriched with the buyer's territory (nation is tiny: broadcast)
    oh = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")
          .select("o_orderkey", "o_custkey", "o_orderdate", "n_regionkey"))
    j = (li.join(oh, li.l_orderkey == oh.o_orderkey, "inner")
         .join(p, li.l_partkey == p.p_partkey, "left"))
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    okl = ok + ln
    # amounts that several columns use are columns of their own, so that each is converted once a row
    j = j.withColumns({"_ext": _dec("l_extendedprice"), "_disc": _dec("l_discount"), "_odate": F.to_date("o_orderdate")})
    ext, disc, odate = F.col("_ext"), F.col("_disc"), F.col("_odate")
    j = j.withColumn("_amount", F.when(okl % 317 == 0, F.lit(-1).cast(X.MONEY)).otherwise(_dec(ext * (F.lit(1) - disc))))
    sales_amt = F.col("_amount")
    qty_raw = F.col("l_quantity")
    qty = F.when(okl % 307 == 0, F.lit(0)).otherwise(qty_raw).cast("long")
    unit_units = F.when(qty_raw.cast("long") == 0, F.lit(None)).otherwise(
        F.expr("cast(round(l_extendedprice * 100) as bigint) * 100 div cast(l_quantity as bigint)"))
    unit_price = F.when(okl % 311 == 0, F.lit(0).cast(X.MONEY)).otherwise(
        _dec(unit_units.cast("decimal(18,0)") * F.lit(Decimal("0.0001"))))
    cost = _dec(_dec(_dec("p_retailprice") * F.lit(Decimal("0.6"))) * _dec(qty_raw))
    return j.select(
        F.when(ok % 499 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("SO"), ok.cast("string"))).alias("SalesOrderNumber"),
        ln.cast("int").alias("SalesOrderLineNumber"),
        F.when(okl % 313 == 0, F.lit(-1)).otherwise(F.col("l_partkey").cast("long") + 1).alias("ProductKey"),
        (F.col("o_custkey").cast("long") * 17 + 1).alias("CustomerKey"),
        (F.col("n_regionkey") + 1).cast("long").alias("SalesTerritoryKey"),
        X.date_key(odate).alias("OrderDateKey"),
        X.date_key(F.to_date("l_shipdate")).alias("ShipDateKey"),
        X.date_key(F.date_add(odate, 12)).alias("DueDateKey"),
        qty.alias("OrderQuantity"),
        unit_price.alias("UnitPrice"),
        disc.alias("UnitPriceDiscountPct"),
        F.when(ok % 53 == 0, F.lit(None).cast(X.MONEY)).otherwise(ext).alias("ExtendedAmount"),
        cost.alias("TotalProductCost"),
        sales_amt.alias("SalesAmount"),
        _dec(sales_amt * _dec("l_tax")).alias("TaxAmt"),
        _dec(sales_amt * F.lit(Decimal("0.025"))).alias("Freight"),
        F.struct(*[F.col(c) for c in SALES_ORDER_COLS]).alias("src_order"),
    )


def product_inventory(t) -> DataFrame:
    li = t["lineitem"]
    p = t["part"].select("p_partkey", "p_size", "p_retailprice")
    month = F.trunc(F.to_date("l_shipdate"), "month")
    # partial aggregation first: one row per (part, month) reaches the join
    pm = li.groupBy(F.col("l_partkey"), month.alias("m")).agg(F.sum("l_quantity").alias("q"))
    j = pm.join(p, pm.l_partkey == p.p_partkey, "inner")
    k = F.col("p_partkey")
    units = (F.col("q") * F.col("p_size") * 3 - 30).cast("long")
    cost = _dec(_dec("p_retailprice") * F.lit(Decimal("0.6")))
    base = j.select(
        (k.cast("long") + 1).alias("ProductKey"),
        X.date_key("m").alias("DateKey"),
        units.alias("UnitsBalance"),
        F.when(k % 79 == 0, -cost).otherwise(cost).cast(X.MONEY).alias("UnitCost"),
        F.col("m").cast("timestamp").alias("MovementDate"),
        k.alias("_pk"))
    second = (base.where(F.col("_pk") % 61 == 0)
              .withColumn("UnitsBalance", F.col("UnitsBalance") + 1)
              .withColumn("MovementDate", F.col("MovementDate") + F.expr("INTERVAL 1 DAY")))
    return base.unionByName(second).drop("_pk")


def driver_raw(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw source tables (unshifted dates), keyed like the original extract."""
    return {
        "dim_geography": geography(t),
        "dim_sales_territory": territory(t),
        "dim_product_category": category(spark),
        "dim_product_subcategory": subcategory(spark, t),
        "dim_product": product(t),
        "dim_customer": customer(t),
        "fact_internet_sales": internet_sales(t),
        "fact_product_inventory": product_inventory(t),
    }


def write_source_layer(spark: SparkSession, t: dict[str, DataFrame], path: str, names: list[str] | None = None) -> None:
    """The raw tables (or those of ``names``) as the retail warehouse stores them, one Parquet folder per
    source table under its own column names; products with key mod 103 = 0 have no list price."""
    raw = driver_raw(spark, t)
    for name, df in ((n, raw[n]) for n in names or raw):
        table, cols, _ = SOURCE_SCANS[name]
        if name == "dim_product":
            df = df.withColumn("ListPrice", F.when(F.col("ProductKey") % 103 != 0, F.col("ListPrice")))
        df.select(*[F.col(c) if isinstance(c, str) else F.col(c[1]).alias(c[0]) for c in cols]) \
            .write.mode("overwrite").parquet(f"{path}/{table}")


def changed_star(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A later state of the star's tables, by fixed modulo rules: changed prices, segments, zones and
    stock, new drugs, customers, order lines and snapshots; the rest as it was."""
    out = dict(tables)
    far = 10_000_000

    def more(df, when, **new):
        return df.unionByName(df.where(when).withColumns({c: F.expr(e) for c, e in new.items()}))

    drug = tables["dim_drug"].withColumn("unit_price", F.expr("IF(drug_key % 7 = 0, CAST(unit_price + 1 AS DECIMAL(18,4)), unit_price)"))
    out["dim_drug"] = more(drug, "drug_key % 50 = 0", drug_key=f"drug_key + {far}", source_product_key=f"source_product_key + {far}",
                           drug_name="concat(drug_name, ' II')")
    cust = tables["dim_customer"].withColumn("customer_segment", F.expr("IF(customer_key % 11 = 0, 'Reviewed', customer_segment)"))
    out["dim_customer"] = more(cust, "customer_key % 40 = 0", customer_key=f"customer_key + {far}",
                               source_customer_key=f"source_customer_key + {far}", customer_name="concat(customer_name, ' II')")
    out["dim_geography"] = tables["dim_geography"].withColumn(
        "distribution_zone", F.expr("IF(geography_key % 5 = 0, 'International Zone', distribution_zone)"))
    out["fact_drug_sales"] = more(tables["fact_drug_sales"], "drug_key % 25 = 0", source_order_line_num="source_order_line_num + 1000")
    inv = tables["fact_inventory"].withColumn("units_on_hand", F.expr("IF(drug_key % 5 = 0, units_on_hand + 1, units_on_hand)"))
    out["fact_inventory"] = more(inv, "drug_key % 20 = 0", snapshot_date_key="snapshot_date_key + 14")
    return out


def load_driver_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return driver_raw(spark, read_driver_tables(spark, sf_dir))


# ------------------------------------------------------------------ uploads
# Daily upload files derived from the driver tables and the star's names.  Every
# lineitem becomes one sales-upload row; fixed modulo rules add the dirt that
# exercises each upload rule.  Columns are strings, as read from a CSV.

def _s(c):
    return c.cast("string")


def sales_upload(t: dict[str, DataFrame], star_tables: dict[str, DataFrame], shift_years: int) -> DataFrame:
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                              "l_discount", "l_tax")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    p = t["part"].select("p_partkey", "p_retailprice")
    drug = star_tables["dim_drug"].select(F.col("drug_key").alias("_dk"), F.col("drug_name").alias("_dn"))
    cust = star_tables["dim_customer"].select(F.col("customer_key").alias("_ck"), F.col("customer_name").alias("_cn"),
                                              F.col("customer_type").alias("_ct"),
                                              F.col("geography_key").alias("_gk"))
    geo = star_tables["dim_geography"].select(F.col("geography_key").alias("_gk"), F.col("country_region").alias("_co"),
                                              F.col("city").alias("_ci"))
    terr = t["nation"].join(F.broadcast(t["region"]), F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("n_nationkey"), F.col("r_name").alias("_tn"))
    c = t["customer"].select("c_custkey", "c_nationkey")
    # parts meet their drugs and orders their buyers first, so that the lines are shuffled once for each of the two
    parts = p.join(drug, F.col("p_partkey") + 1 == F.col("_dk"), "full_outer").select(
        F.coalesce(F.col("p_partkey"), F.col("_dk") - 1).alias("_pk"), "p_retailprice", "_dn")
    buyers = (o.join(cust, F.col("o_custkey") * 17 + 1 == F.col("_ck"), "left")
              .join(geo, "_gk", "left")
              .join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
              .join(F.broadcast(terr), F.col("c_nationkey") == F.col("n_nationkey"), "left")
              .select("o_orderkey", "o_custkey", "o_orderdate", "_cn", "_ct", "_co", "_ci", "_tn"))
    j = (li.join(parts, li.l_partkey == F.col("_pk"), "left")
         .join(buyers, li.l_orderkey == F.col("o_orderkey"), "inner"))
    ok = F.col("l_orderkey")
    token = F.split(F.col("_dn"), " ").getItem(0)
    drug_name = (F.when(ok % 13 == 0, F.concat(F.lit("Qx-"), _s(F.col("l_partkey")), F.lit(" Tablet")))
                 .when(F.col("_dn").isNull(), F.concat(F.lit("Qx-"), _s(F.col("l_partkey"))))
                 .when(ok % 11 == 0, F.concat(token, F.lit(" xyz")))
                 .when(ok % 7 == 0, F.upper(F.col("_dn")))
                 .otherwise(F.col("_dn")))
    new_buyer = (ok % 5 == 0) | F.col("_cn").isNull()
    cust_name = F.when(new_buyer, F.concat(F.lit("New Buyer "), _s(F.col("o_custkey") % 50))).otherwise(F.col("_cn"))
    cust_type = F.when(new_buyer, F.lit("Government office")).otherwise(F.lower(F.col("_ct")))
    qty = F.col("l_quantity").cast("long")
    # amounts as exact DECIMAL(18,2) text (rounding half-up), as an exporting system would print them
    d2 = lambda c: F.round(c, 2).cast("decimal(18,2)").cast("string")
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    j = j.withColumns({"_disc": F.col("l_discount").cast("decimal(18,2)"),
                       "_odate": F.add_months(F.to_date("o_orderdate"), 12 * shift_years)})
    disc, odate = F.col("_disc"), F.col("_odate")
    j = j.withColumn("_net", ext * (F.lit(1) - disc))
    net = F.col("_net")
    unit_cents = F.expr("(2 * cast(round(l_extendedprice * 100) as bigint) + cast(l_quantity as bigint))"
                        " div (2 * cast(l_quantity as bigint))")
    unit = (unit_cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)").cast("string")
    unit_cost = F.col("p_retailprice").cast("decimal(18,2)") * F.lit(Decimal("0.6"))
    cost = F.when(F.col("l_linenumber") % 2 == 0, unit_cost).otherwise(unit_cost * qty)
    return j.select(
        drug_name.alias("drug_name"),
        cust_name.alias("customer_name"),
        cust_type.alias("customer_type"),
        F.when(ok % 23 == 0, F.lit("n/a")).when(ok % 19 == 0, F.date_format(odate, "M/d/yyyy"))
         .when(ok % 17 == 0, F.date_format(odate, "yyyy-MM-dd'T'10:30:00")).otherwise(F.date_format(odate, "yyyy-MM-dd"))
         .alias("order_date"),
        F.when(ok % 29 == 0, F.lit("0")).otherwise(_s(qty)).alias("units_sold"),
        F.when(ok % 31 == 0, F.lit("0")).otherwise(unit).alias("unit_price"),
        d2(disc * 100).alias("unit_price_discount_pct"),
        d2(cost).alias("total_product_cost"),
        d2(net).alias("sales_amount"),
        d2(net * F.col("l_tax").cast("decimal(18,2)")).alias("tax_amt"),
        d2(net * F.lit(Decimal("0.025"))).alias("freight"),
        F.coalesce(F.col("_tn"), F.lit("")).alias("sales_territory_name"),
        F.coalesce(F.col("_co"), F.lit("Brazil")).alias("country_region"),
        F.coalesce(F.col("_ci"), F.lit("")).alias("city"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_row"),
    )


def inventory_upload(t: dict[str, DataFrame], star_tables: dict[str, DataFrame], snapshot_date: str) -> DataFrame:
    """One snapshot date; every drug with its latest on-hand units; ordered = size*10,
    dispatched = size mod 7 (0 gives a null days of supply); parts with key mod 37 = 0
    appear twice (the later row, +5 units, must win)."""
    fi = star_tables["fact_inventory"]
    latest = X.dedupe(fi.select("drug_key", "snapshot_date_key", "units_on_hand"), ["drug_key"],
                      [F.col("snapshot_date_key")], "last")
    d = star_tables["dim_drug"].select("drug_key", "drug_name", "unit_cost")
    p = t["part"].select("p_partkey", "p_size")
    j = d.join(latest, "drug_key", "left").join(p, F.col("drug_key") == F.col("p_partkey") + 1, "inner")
    base = j.select(
        F.col("drug_name"),
        F.lit(snapshot_date).alias("snapshot_date"),
        _s(F.coalesce(F.col("units_on_hand"), F.lit(0))).alias("units_on_hand"),
        _s(F.col("p_size") * 10).alias("units_ordered"),
        _s(F.col("p_size") % 7).alias("units_dispatched"),
        _s(F.col("unit_cost")).alias("unit_cost"),
        (F.col("drug_key") * 2).alias("_row"),
        F.col("p_partkey"))
    dup = (base.where(F.col("p_partkey") % 37 == 0)
           .withColumn("units_on_hand", _s(F.col("units_on_hand").cast("long") + 5))
           .withColumn("_row", F.col("_row") + 1))
    return base.unionByName(dup).drop("p_partkey")
