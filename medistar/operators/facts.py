"""FACT-1..FACT-5: conform the sales and inventory facts.

Key checks are joins against the conformed dimensions (never driver-side
sets).  The calendar is broadcast: its size is bounded by the calendar
parameters (see ``sources.calendar.MAX_CALENDAR_DAYS``).  Drug and customer
are joined without hints so that AQE picks broadcast only when the runtime
size allows it and a shuffle join otherwise.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.operators.conform import Conformed, Counted, duplicate_report, fact_tracker, flag, track, union_all, waterfall_report
from medistar.params import Params

FACT_SALES_COLS = [
    "order_date_key", "ship_date_key", "due_date_key", "drug_key", "customer_key", "geography_key",
    "territory_key", "source_order_number", "source_order_line_num", "source_system", "units_sold",
    "unit_price", "unit_price_discount_pct", "gross_revenue", "discount_amount", "net_revenue",
    "cost_of_goods", "gross_profit", "gross_margin_pct", "tax_amount", "freight_cost", "etl_batch_id",
    "order_year",
]

FACT_INVENTORY_COLS = [
    "snapshot_date_key", "drug_key", "units_on_hand", "units_ordered", "units_dispatched",
    "safety_stock_level", "reorder_point", "stock_value", "days_of_supply", "stock_status", "etl_batch_id",
    "snapshot_year",
]

# facts are stored partitioned by year; the column is part of the schema
PARTITION_COLS = {"fact_drug_sales": ("order_year", "order_date_key"),
                  "fact_inventory": ("snapshot_year", "snapshot_date_key")}


def year_of(date_key) -> F.Column:
    """yyyy of a yyyymmdd key (the storage partition of a fact row)."""
    return F.floor(X.col(date_key) / 10000).cast("int")


def margin_pct(profit, net):
    """round(profit / net * 100, 4) with exact decimal arithmetic (half-up); 0 when net <= 0."""
    n = X.col(net)
    return F.when(n > 0, X.exact_pct(profit, net, 4)).otherwise(F.lit(0)).cast(X.PCT)


def _date_keys(dim_date: DataFrame) -> DataFrame:
    return F.broadcast(dim_date.select(F.col("date_key")).distinct())


def _dedupe(kept: DataFrame, keys: list[str], measures: list[Column], n_order: int, keep: str,
            fixes: dict[str, Column]) -> DataFrame:
    """One row per ``keys`` (columns of ``kept`` beside ``measures``) by the columns ``_ord0``, ...

    While the facts are counted, rows with a reason come along: they lose their keys, so that they meet in one row
    per reason, whose number is all that is wanted of them, and the fixes are counted."""
    order = [f"_ord{i}" for i in range(n_order)]
    rest = [*measures, *[F.col(c) for c in order]]
    if fact_tracker() is None:
        return X.dedupe(kept.select(*keys, *rest), keys, order, keep, count_col="_dups")
    good = F.col("_reason").isNull()
    sums = {f"_fixed_{n}": F.when(good & c, 1).otherwise(0).cast("long").alias(f"_fixed_{n}") for n, c in fixes.items()}
    m = kept.select(*[F.when(good, F.col(k)).alias(k) for k in keys], "_reason", *rest, *sums.values())
    return X.dedupe(m, [*keys, "_reason"], order, keep, count_col="_dups", sum_cols=list(sums))


def _counted(rows: DataFrame, table: str, cols: list[str], reasons: list[str], fixes: dict[str, Column]) -> DataFrame:
    """The clean rows; where facts are counted, the tracker gets them with their counts, in a partition without a year if removed."""
    if fact_tracker() is None:
        return rows.select(*cols)
    part, _ = PARTITION_COLS[table]
    rows = rows.withColumn(part, F.when(F.col("_reason").isNull(), F.col(part)))
    fact_tracker().counted[table] = Counted(rows.select(*cols, "_reason", "_dups", *[f"_fixed_{n}" for n in fixes]), reasons, list(fixes))
    return rows.where(F.col("_reason").isNull()).select(*cols)


def transform_fact_sales(raw: DataFrame, dim_drug: DataFrame, dim_customer: DataFrame,
                         dim_date: DataFrame, dim_territory: DataFrame, params: Params,
                         order_cols=("src_order",)) -> Conformed:
    sch = raw.schema
    s = raw.select(
        X.safe_str("SalesOrderNumber", "").alias("order_num"),
        X.safe_int("SalesOrderLineNumber", 1, sch).alias("line"),
        X.safe_int("ProductKey", -1, sch).alias("pk"),
        X.safe_int("CustomerKey", -1, sch).alias("ck"),
        X.safe_date_key("OrderDateKey", -1, sch).alias("dk"),
        X.safe_date_key("ShipDateKey", 0, sch).alias("sdk0"),
        X.safe_date_key("DueDateKey", 0, sch).alias("ddk0"),
        X.safe_int("SalesTerritoryKey", 0, sch).alias("tk0"),
        X.safe_int("OrderQuantity", 0, sch).alias("qty"),
        X.safe_money("UnitPrice", 0).alias("price"),
        X.safe_money("UnitPriceDiscountPct", 0).alias("disc"),
        F.expr("try_cast(ExtendedAmount AS DECIMAL(18,4))").alias("ext"),
        X.safe_money("TotalProductCost", 0).alias("cost0"),
        X.safe_money("SalesAmount", 0).alias("net"),
        X.safe_money("TaxAmt", 0).alias("tax"),
        X.safe_money("Freight", 0).alias("frt"),
        *[F.col(c).alias(f"_ord{i}") for i, c in enumerate(order_cols)],
    )
    # SNK-5: drug / customer keys (rows without them are rejected and counted), territory nullable
    drugs = dim_drug.select(F.col("source_product_key").alias("pk"), F.col("drug_key"))
    custs = dim_customer.select(F.col("source_customer_key").alias("ck"), F.col("customer_key"),
                                F.col("geography_key"))
    dates = _date_keys(dim_date)
    j = (s.join(drugs, "pk", "left")
         .join(custs, "ck", "left")
         .join(dates.withColumnRenamed("date_key", "_dk"), F.col("dk") == F.col("_dk"), "left"))
    flagged, reasons = flag(j, [
        (F.col("order_num") == "", "null_order_number"),
        (F.col("drug_key").isNull(), "drug_not_found"),
        (F.col("customer_key").isNull(), "customer_not_found"),
        (F.col("_dk").isNull(), "date_not_found"),
        (F.col("dk") > params.as_of_key, "future_date"),
        (F.col("qty") <= 0, "zero_quantity"),
        (F.col("price") <= 0, "zero_or_null_price"),
        (F.col("net") < 0, "negative_revenue"),
    ])
    net = F.col("net")
    cost_pos = F.greatest(F.col("cost0"), F.lit(0).cast(X.MONEY))
    flagged = flagged.withColumn("_cost_fixed", (net > 0) & (cost_pos > net * 2))
    fixes = {"anomalous_cost_fixed": F.col("_cost_fixed")}
    # what only the lookups needed is not written
    flagged = track(flagged.drop("pk", "ck", "_dk"), "fact_drug_sales", reasons, fixes)
    kept = flagged if fact_tracker() else flagged.where(F.col("_reason").isNull())
    # ship / due keys must exist in the calendar; else null
    kept = (kept.join(dates.withColumnRenamed("date_key", "ship_date_key"),
                      F.col("sdk0") == F.col("ship_date_key"), "left")
            .join(dates.withColumnRenamed("date_key", "due_date_key"),
                  F.col("ddk0") == F.col("due_date_key"), "left"))
    terr = dim_territory.select(F.col("source_territory_key").alias("tk0"), F.col("territory_key"))
    kept = kept.join(terr, "tk0", "left")
    # FACT-2: derived measures; those that follow from others are added after the dedupe, which then sorts narrower rows
    gross = F.coalesce(F.col("ext"), F.col("price") * F.col("qty")).cast(X.MONEY)
    cost = F.when(F.col("_cost_fixed"), F.round(net * F.lit(Decimal("0.60")), 4)).otherwise(cost_pos).cast(X.MONEY)
    disc100 = F.col("disc") * 100
    kept = kept.withColumns({"_gross": gross, "_cost": cost, "source_order_number": F.col("order_num"),
                             "source_order_line_num": F.col("line")})
    gross = F.col("_gross")
    # FACT-3: one row per order line of the source system, first in source order
    keys = ["source_order_number", "source_order_line_num"]
    measures = [
        F.col("dk").alias("order_date_key"),
        *[F.col(c) for c in ["ship_date_key", "due_date_key", "drug_key", "customer_key", "geography_key", "territory_key"]],
        F.col("qty").alias("units_sold"),
        F.round(F.col("price"), 4).cast(X.MONEY).alias("unit_price"),
        F.least(F.greatest(disc100, F.lit(0)), F.lit(100)).cast(X.PCT).alias("unit_price_discount_pct"),
        F.round(gross, 4).cast(X.MONEY).alias("gross_revenue"),
        F.round(gross * F.col("disc"), 4).cast(X.MONEY).alias("discount_amount"),
        F.round(net, 4).cast(X.MONEY).alias("net_revenue"),
        F.col("_cost").alias("cost_of_goods"),
        F.round(F.col("tax"), 4).cast(X.MONEY).alias("tax_amount"),
        F.round(F.col("frt"), 4).cast(X.MONEY).alias("freight_cost"),
    ]
    deduped = _dedupe(kept, keys, measures, len(order_cols), "first", fixes)
    # what several measures use is a column of its own, so that it is computed once a row
    clean = deduped.withColumn("_profit", F.col("net_revenue") - F.col("cost_of_goods"))
    clean = clean.withColumns({
        "source_system": F.lit(params.source_system),
        "gross_profit": F.col("_profit").cast(X.MONEY),
        "gross_margin_pct": margin_pct("_profit", "net_revenue"),
        "etl_batch_id": F.lit(params.batch_id),
        "order_year": year_of("order_date_key"),
    })
    clean = _counted(clean, "fact_drug_sales", FACT_SALES_COLS, reasons, fixes)
    report = union_all(waterfall_report(flagged, "fact_drug_sales", fixes=fixes)
                       + [duplicate_report(deduped, "fact_drug_sales", reason="duplicate_order_lines")])
    return Conformed(clean, report)


def transform_fact_inventory(raw: DataFrame, dim_drug: DataFrame, dim_date: DataFrame,
                             params: Params, order_cols=("MovementDate", "UnitsBalance", "UnitCost")) -> Conformed:
    """FACT-4 waterfall and measures, SNK-6 drug key resolution, FACT-5 keep the last snapshot."""
    sch = raw.schema
    s = raw.select(
        X.long_key("ProductKey", sch).alias("pk"),
        X.safe_date_key("DateKey", schema=sch).alias("dk"),
        X.safe_int("UnitsBalance", 0, sch).alias("units0"),
        X.safe_money("UnitCost", 0).alias("cost0"),
        *[F.col(c).alias(f"_ord{i}") for i, c in enumerate(order_cols)],
    )
    drugs = dim_drug.select(F.col("source_product_key").alias("pk"), F.col("drug_key"))
    dates = _date_keys(dim_date).withColumnRenamed("date_key", "_dk")
    j = s.join(drugs, "pk", "left").join(dates, F.col("dk") == F.col("_dk"), "left")
    flagged, reasons = flag(j, [
        (F.col("pk").isNull(), "null_product_key"),
        (F.col("dk").isNull(), "null_date_key"),
        (F.col("drug_key").isNull(), "drug_not_found"),
        (F.col("_dk").isNull(), "date_not_found"),
        (F.col("dk") > params.as_of_key, "future_date"),
    ])
    flagged = (flagged.withColumn("_neg_units", F.col("units0") < 0)
               .withColumn("_neg_cost", F.col("cost0") < 0))
    fixes = {"negative_units_fixed": F.col("_neg_units"), "negative_cost_fixed": F.col("_neg_cost")}
    flagged = track(flagged, "fact_inventory", reasons, fixes)
    kept = flagged if fact_tracker() else flagged.where(F.col("_reason").isNull())
    units = F.greatest(F.col("units0"), F.lit(0))
    cost = F.greatest(F.col("cost0"), F.lit(0).cast(X.MONEY))
    measures = [
        units.alias("units_on_hand"),
        F.round(units * cost, 4).cast(X.MONEY).alias("stock_value"),
    ]
    # constants and what follows from other columns come after the dedupe, which then sorts narrower rows
    deduped = _dedupe(kept.withColumn("snapshot_date_key", F.col("dk")), ["snapshot_date_key", "drug_key"], measures,
                      len(order_cols), "last", fixes)
    clean = deduped.withColumns({
        "units_ordered": F.lit(0).cast("long"),
        "units_dispatched": F.lit(0).cast("long"),
        "safety_stock_level": F.lit(0),
        "reorder_point": F.lit(0),
        "days_of_supply": F.lit(None).cast(X.DAYS),
        "stock_status": X.stock_status("units_on_hand"),
        "etl_batch_id": F.lit(params.batch_id),
        "snapshot_year": year_of("snapshot_date_key"),
    })
    clean = _counted(clean, "fact_inventory", FACT_INVENTORY_COLS, reasons, fixes)
    report = union_all(waterfall_report(flagged, "fact_inventory", fixes=fixes)
                       + [duplicate_report(deduped, "fact_inventory", reason="duplicate_snapshots")])
    return Conformed(clean, report)
