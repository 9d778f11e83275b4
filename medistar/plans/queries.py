"""Query library over the star (dashboard, analytics, search, reports, marts).

Every query is ``f(star, start=None, end=None, **filters) -> DataFrame`` built
with the DataFrame API only: star joins, grouped aggregates and top-k.  Money
is summed as DECIMAL (exact, order-independent) and cast to DOUBLE at the end;
ratios are computed in DOUBLE.  Every ``limit`` has a unique tie-break.

Joins carry no broadcast hints on drug / customer (they can be as large as the
facts); AQE converts them to broadcast joins at runtime when the measured side
is small.  The date filter is applied to ``dim_date`` and, because date keys
are yyyymmdd and therefore monotone in the date, also directly to the fact's
date key so Parquet min/max statistics skip row groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.functions import fixed
from medistar.plans.star import Star

BIG = 10 ** 15


# ------------------------------------------------------------------ helpers

def dbl_sum(c) -> Column:
    return F.sum(X.col(c)).cast("double")


def mean(c) -> Column:
    """AVG as sum / count in DOUBLE (nulls ignored)."""
    return F.sum(X.col(c)).cast("double") / F.count(X.col(c))


def weighted_margin(profit="gross_profit", net="net_revenue") -> Column:
    sp, sn = F.sum(X.col(profit)), F.sum(X.col(net))
    return F.when(sn == 0, F.lit(0.0)).otherwise(sp.cast("double") * F.lit(100.0) / sn.cast("double"))


def long_sum(c) -> Column:
    return F.sum(X.col(c)).cast("long")


PRESETS = ("All Time", "Today", "Yesterday", "Last 7 Days", "Last 30 Days", "Last 90 Days",
           "Last 6 Months", "This Year", "Last Year")


def preset_range(name: str, as_of: dt.date) -> tuple[str | None, str | None]:
    """FIL-1 presets resolved on the driver against a fixed ``as_of`` date."""
    d = as_of
    presets = {
        "All Time": (dt.date(2005, 1, 1), d),
        "Today": (d, d),
        "Yesterday": (d - dt.timedelta(days=1), d - dt.timedelta(days=1)),
        "Last 7 Days": (d - dt.timedelta(days=7), d),
        "Last 30 Days": (d - dt.timedelta(days=30), d),
        "Last 90 Days": (d - dt.timedelta(days=90), d),
        "Last 6 Months": (d - dt.timedelta(days=180), d),
        "This Year": (dt.date(d.year, 1, 1), d),
        "Last Year": (dt.date(d.year - 1, 1, 1), dt.date(d.year - 1, 12, 31)),
    }
    if name not in presets:
        raise ValueError(f"unknown date preset {name!r}")
    s, e = presets[name]
    return s.isoformat(), e.isoformat()


def _key(d: str) -> int:
    x = dt.date.fromisoformat(str(d))
    return x.year * 10000 + x.month * 100 + x.day


def _dates(star: Star, start, end, cols=("date_key", "full_date", "calendar_year", "month_num")) -> DataFrame:
    d = star["dim_date"].select(*dict.fromkeys(cols))
    if start is not None:
        d = d.where(F.col("full_date") >= F.lit(start).cast("date"))
    if end is not None:
        d = d.where(F.col("full_date") <= F.lit(end).cast("date"))
    return d


YEAR_COLS = {"order_date_key": "order_year", "snapshot_date_key": "snapshot_year"}


def _key_range(df: DataFrame, key: str, start, end) -> DataFrame:
    """Date-key range on a fact; also on its year partition column, so a written
    (year-partitioned) fact prunes directories before any file is opened."""
    year = YEAR_COLS.get(key)
    has_year = year in df.columns
    if start is not None:
        df = df.where(F.col(key) >= _key(start))
        if has_year:
            df = df.where(F.col(year) >= _key(start) // 10000)
    if end is not None:
        df = df.where(F.col(key) <= _key(end))
        if has_year:
            df = df.where(F.col(year) <= _key(end) // 10000)
    return df


def sales(star: Star, start=None, end=None, date_cols=("date_key",)) -> DataFrame:
    """Fact rows whose order date is in [start, end], joined to the calendar."""
    f = _key_range(star["fact_drug_sales"], "order_date_key", start, end)
    d = _dates(star, start, end, ("date_key", "full_date", *date_cols))
    return f.join(d, f.order_date_key == d.date_key, "inner")


def _join_drug_class(f: DataFrame, star: Star, drug_cols=("drug_name",),
                     class_cols=("therapeutic_class",)) -> DataFrame:
    """fact -> drug -> class, joined one dimension at a time (each join's build
    side is one dimension, so its size estimate is that table's, not a product)."""
    dr = star["dim_drug"].select("drug_key", "therapeutic_class_key", *drug_cols)
    t = star["dim_therapeutic_class"].select("therapeutic_class_key", *class_cols)
    return f.join(dr, "drug_key", "inner").join(t, "therapeutic_class_key", "inner")


# ------------------------------------------------------- dashboard (Q-1..Q-19)

def kpi_summary(star: Star, start=None, end=None) -> DataFrame:
    """Q-1."""
    return sales(star, start, end).agg(
        dbl_sum("net_revenue").alias("rev"),
        dbl_sum("gross_profit").alias("prof"),
        weighted_margin().alias("mgn"),
        F.count(F.lit(1)).alias("orders"),
        long_sum("units_sold").alias("units"),
        F.countDistinct("customer_key").alias("custs"),
        F.countDistinct("drug_key").alias("drugs"))


def kpi_by_preset(star: Star, as_of: dt.date) -> DataFrame:
    """FIL-1 with Q-1: the KPIs of every preset range from one scan of the fact; a
    range without sales has no sums and zero counts."""
    ranges = {p: preset_range(p, as_of) for p in PRESETS}
    day = F.col("full_date")
    inside = F.array_compact(F.array(*[
        F.when((day >= F.lit(a).cast("date")) & (day <= F.lit(b).cast("date")), F.lit(p)) for p, (a, b) in ranges.items()]))
    dates = star["dim_date"].select("date_key", F.explode(inside).alias("preset"))
    fact = _key_range(star["fact_drug_sales"], "order_date_key",
                      min(a for a, _ in ranges.values()), max(b for _, b in ranges.values()))
    found = fact.join(dates, F.col("order_date_key") == F.col("date_key")).groupBy("preset").agg(
        dbl_sum("net_revenue").alias("revenue"),
        dbl_sum("gross_profit").alias("profit"),
        weighted_margin().alias("margin_pct"),
        F.count(F.lit(1)).alias("orders"),
        long_sum("units_sold").alias("units"),
        F.countDistinct("customer_key").alias("customers"),
        F.countDistinct("drug_key").alias("drugs"))
    names = star["dim_date"].select(F.explode(F.array(*[F.lit(p) for p in PRESETS])).alias("preset")).distinct()
    return names.join(found, "preset", "left").fillna(0, ["orders", "customers", "drugs"])


def calendar_activity(star: Star) -> DataFrame:
    """Every day of the calendar with its sales lines, revenue and stock snapshots;
    the facts are reduced to one row per day before they meet the calendar."""
    sold = star["fact_drug_sales"].groupBy(F.col("order_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("sales_lines"), dbl_sum("net_revenue").alias("revenue"))
    held = star["fact_inventory"].groupBy(F.col("snapshot_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("stock_rows"))
    return star["dim_date"].select("date_key", "full_date", "calendar_year", "month_num") \
        .join(sold, "date_key", "left").join(held, "date_key", "left").fillna(0, ["sales_lines", "stock_rows"])


def class_activity(star: Star) -> DataFrame:
    """Every therapeutic class with its drugs and sales; classes without either stay."""
    drugs = star["dim_drug"].select("drug_key", "therapeutic_class_key")
    held = drugs.groupBy("therapeutic_class_key").agg(F.count(F.lit(1)).alias("drugs"))
    sold = star["fact_drug_sales"].groupBy("drug_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net_revenue").alias("net")).join(drugs, "drug_key") \
        .groupBy("therapeutic_class_key").agg(long_sum("lines").alias("sales_lines"), dbl_sum("net").alias("revenue"))
    return star["dim_therapeutic_class"].select("therapeutic_class_key", "therapeutic_class") \
        .join(held, "therapeutic_class_key", "left").join(sold, "therapeutic_class_key", "left") \
        .fillna(0, ["drugs", "sales_lines"])


def stock_risk_counts(star: Star) -> DataFrame:
    """Q-3: one pass over inventory."""
    s = F.col("stock_status")
    return star["fact_inventory"].agg(
        F.count_if(s == fixed.STOCK_OUT).alias("out_of_stock"),
        F.count_if(s.isin(fixed.STOCK_LOW, fixed.STOCK_CRITICAL)).alias("low_or_critical"))


def kpi_insights(star: Star, start=None, end=None) -> DataFrame:
    """Q-2: average order value, profit per unit, inventory-risk count."""
    k = kpi_summary(star, start, end).withColumn("_one", F.lit(1))
    r = stock_risk_counts(star).withColumn("_one", F.lit(1))
    j = k.join(r, "_one", "inner")
    return j.select(
        F.when(F.col("orders") == 0, F.lit(0.0)).otherwise(F.coalesce(F.col("rev"), F.lit(0.0)) / F.col("orders"))
         .alias("avg_order_value"),
        F.when(F.coalesce(F.col("units"), F.lit(0)) == 0, F.lit(0.0))
         .otherwise(F.col("prof") / F.col("units")).alias("profit_per_unit"),
        (F.col("out_of_stock") + F.col("low_or_critical")).alias("inventory_risk"))


def _period(year="calendar_year", month="month_num") -> Column:
    return F.concat(F.col(year).cast("string"), F.lit("-"), F.lpad(F.col(month).cast("string"), 2, "0"))


def monthly_trend(star: Star, start=None, end=None) -> DataFrame:
    """Q-4."""
    return (sales(star, start, end, ("calendar_year", "month_num"))
            .groupBy("calendar_year", "month_num")
            .agg(dbl_sum("net_revenue").alias("revenue"), dbl_sum("gross_profit").alias("profit"),
                 long_sum("units_sold").alias("units"))
            .select(_period().alias("period"), "calendar_year", "month_num", "revenue", "profit", "units")
            .orderBy("period"))


def top_drugs(star: Star, n: int = 5, start=None, end=None) -> DataFrame:
    """Q-5: drug by revenue, units, mean margin; revenue desc, name as tie-break."""
    f = sales(star, start, end)
    dr = star["dim_drug"].select("drug_key", "drug_name")
    return (f.join(dr, "drug_key", "inner")
            .groupBy("drug_name")
            .agg(dbl_sum("net_revenue").alias("rev"), long_sum("units_sold").alias("units"),
                 mean("gross_margin_pct").alias("mgn"))
            .orderBy(F.desc("rev"), F.asc("drug_name")).limit(n))


def revenue_by_customer_type(star: Star, start=None, end=None) -> DataFrame:
    """Q-6."""
    c = star["dim_customer"].select("customer_key", "customer_type")
    return (sales(star, start, end).join(c, "customer_key", "inner")
            .groupBy(F.col("customer_type").alias("type"))
            .agg(dbl_sum("net_revenue").alias("rev"), F.countDistinct("customer_key").alias("custs"),
                 F.count(F.lit(1)).alias("orders"), mean("net_revenue").alias("aov"))
            .orderBy(F.desc("rev"), "type"))


def revenue_by_class(star: Star, start=None, end=None, n: int | None = None) -> DataFrame:
    """Q-7 (optionally top n)."""
    out = (_join_drug_class(sales(star, start, end), star, ())
           .groupBy(F.col("therapeutic_class").alias("cls"))
           .agg(dbl_sum("net_revenue").alias("rev"))
           .orderBy(F.desc("rev"), "cls"))
    return out.limit(n) if n else out


def class_share(star: Star, start=None, end=None) -> DataFrame:
    """Q-8: revenue and % of total per class.  The total is a window over the
    aggregated rows (one per class), never over the facts."""
    g = (_join_drug_class(sales(star, start, end), star, ())
         .groupBy("therapeutic_class").agg(F.sum("net_revenue").alias("_rev")))
    tot = F.sum("_rev").over(Window.partitionBy())
    return (g.select("therapeutic_class", F.col("_rev").cast("double").alias("rev"),
                     (F.col("_rev").cast("double") * F.lit(100.0) / tot.cast("double")).alias("pct"))
            .orderBy(F.desc("rev"), "therapeutic_class"))


def stock_status_summary(star: Star) -> DataFrame:
    """Q-9: status -> records, distinct drugs, units, value; by severity."""
    return (star["fact_inventory"].groupBy("stock_status")
            .agg(F.count(F.lit(1)).alias("records"), F.countDistinct("drug_key").alias("drugs"),
                 long_sum("units_on_hand").alias("units"), dbl_sum("stock_value").alias("value"))
            .orderBy(X.stock_severity("stock_status"), F.desc("records"), "stock_status"))


def drug_matrix(star: Star, n: int = 25, start=None, end=None, with_form: bool = True) -> DataFrame:
    """Q-10: drug x class (x form); the dashboard variant (n=40) has no form."""
    keys = [F.col("drug_name").alias("drug"), F.col("therapeutic_class").alias("cls")]
    if with_form:
        keys.append(F.col("dosage_form").alias("form"))
    names = ["drug", "cls"] + (["form"] if with_form else [])
    return (_join_drug_class(sales(star, start, end), star, ("drug_name", "dosage_form"))
            .groupBy(*keys)
            .agg(dbl_sum("net_revenue").alias("rev"), dbl_sum("gross_profit").alias("prof"),
                 weighted_margin().alias("mgn"), long_sum("units_sold").alias("units"))
            .orderBy(F.desc("rev"), *names).limit(n))


def revenue_by_country(star: Star, start=None, end=None) -> DataFrame:
    """Q-11 (inner join on the sale's geography)."""
    g = star["dim_geography"].select("geography_key", "country_region")
    return (sales(star, start, end).join(g, "geography_key", "inner")
            .groupBy(F.col("country_region").alias("country"))
            .agg(long_sum("units_sold").alias("units"), dbl_sum("net_revenue").alias("rev"))
            .orderBy(F.desc("rev"), "country"))


def revenue_by_year_yoy(star: Star, start=None, end=None) -> DataFrame:
    """Q-12: growth % against the previous present year; the first year is 0.
    The lag window runs over one row per year, after aggregation."""
    g = (sales(star, start, end, ("calendar_year",)).groupBy(F.col("calendar_year").alias("yr"))
         .agg(dbl_sum("net_revenue").alias("rev"), dbl_sum("gross_profit").alias("prof"),
              F.count(F.lit(1)).alias("orders"), long_sum("units_sold").alias("units")))
    prev = F.lag("rev").over(Window.orderBy("yr"))
    return (g.withColumn("growth", F.coalesce((F.col("rev") - prev) / prev * F.lit(100.0), F.lit(0.0)))
            .orderBy("yr"))


def quarterly(star: Star, start=None, end=None) -> DataFrame:
    """Q-13: chronological by (year, quarter number), not by label."""
    return (sales(star, start, end, ("calendar_year", "quarter_num", "quarter_label"))
            .groupBy("calendar_year", "quarter_num", "quarter_label")
            .agg(dbl_sum("net_revenue").alias("rev"))
            .orderBy("calendar_year", "quarter_num")
            .select(F.col("quarter_label").alias("q"), F.col("calendar_year").alias("yr"), "rev"))


def revenue_by_weekday(star: Star, start=None, end=None) -> DataFrame:
    """Q-14: weekday name and number (Sunday = 0)."""
    f = sales(star, start, end)
    return (f.groupBy(F.date_format("full_date", "EEEE").alias("dow"),
                      (F.dayofweek("full_date") - 1).alias("dow_num"))
            .agg(mean("net_revenue").alias("avg_rev"), F.count(F.lit(1)).alias("orders"))
            .orderBy("dow_num"))


def inventory_movement(star: Star, start=None, end=None) -> DataFrame:
    """Q-15: per snapshot month."""
    fi = _key_range(star["fact_inventory"], "snapshot_date_key", start, end)
    d = _dates(star, start, end, ("date_key", "full_date", "calendar_year", "month_num"))
    return (fi.join(d, fi.snapshot_date_key == d.date_key, "inner")
            .groupBy("calendar_year", "month_num")
            .agg(long_sum("units_dispatched").alias("dispatched"), long_sum("units_ordered").alias("ordered"),
                 long_sum("units_on_hand").alias("on_hand"))
            .select(_period().alias("p"), "dispatched", "ordered", "on_hand").orderBy("p"))


ALERT_STATUSES = [fixed.STOCK_OUT, fixed.STOCK_CRITICAL, fixed.STOCK_LOW]


def stock_alerts(star: Star) -> DataFrame:
    """Q-16 / REP-3: drug x class x alert status; severity, then drug name."""
    fi = star["fact_inventory"].where(F.col("stock_status").isin(ALERT_STATUSES))
    return (_join_drug_class(fi, star)
            .groupBy(F.col("drug_name"), F.col("therapeutic_class").alias("class"), F.col("stock_status"))
            .agg(long_sum("units_on_hand").alias("units"), dbl_sum("stock_value").alias("value"))
            .orderBy(X.stock_severity("stock_status"), "drug_name", "class"))


def stock_alert_counts(star: Star) -> DataFrame:
    """Q-16 header: alert rows (drug x class x status) per status."""
    return (stock_alerts(star).groupBy("stock_status").agg(F.count(F.lit(1)).alias("items"))
            .orderBy(X.stock_severity("stock_status")))


def revenue_by_segment(star: Star, start=None, end=None) -> DataFrame:
    """Q-17."""
    c = star["dim_customer"].select("customer_key", "customer_segment").where(F.col("customer_segment").isNotNull())
    return (sales(star, start, end).join(c, "customer_key", "inner")
            .groupBy(F.col("customer_segment").alias("seg")).agg(dbl_sum("net_revenue").alias("rev"))
            .orderBy(F.desc("rev"), "seg"))


def top_customers(star: Star, n: int = 20, start=None, end=None) -> DataFrame:
    """Q-18."""
    c = star["dim_customer"].select("customer_key", "customer_name", "customer_type")
    return (sales(star, start, end).join(c, "customer_key", "inner")
            .groupBy(F.col("customer_name").alias("name"), F.col("customer_type").alias("type"))
            .agg(dbl_sum("net_revenue").alias("rev"), F.count(F.lit(1)).alias("orders"),
                 weighted_margin().alias("margin"))
            .orderBy(F.desc("rev"), "name", "type").limit(n))


def revenue_by_zone(star: Star, start=None, end=None) -> DataFrame:
    """Q-19."""
    g = star["dim_geography"].select("geography_key", "distribution_zone")
    return (sales(star, start, end).join(g, "geography_key", "inner")
            .groupBy(F.col("distribution_zone").alias("z")).agg(dbl_sum("net_revenue").alias("rev"))
            .orderBy(F.desc("rev"), "z"))


# --------------------------------------------------------------- search

def drug_lookup(star: Star, text: str | None = None, therapeutic_class: str | None = None,
                form: str | None = None, n: int = 100) -> DataFrame:
    """SEA-1: optional filters composed as expressions (never SQL text)."""
    d = star["dim_drug"]
    t = star["dim_therapeutic_class"].select("therapeutic_class_key", "therapeutic_class", "regulatory_category")
    j = d.join(t, "therapeutic_class_key", "inner")
    if text:
        j = j.where(F.lower(F.col("drug_name")).contains(text.lower()))
    if therapeutic_class:
        j = j.where(F.col("therapeutic_class") == therapeutic_class)
    if form:
        j = j.where(F.col("dosage_form") == form)
    return (j.select("drug_code", "drug_name", "dosage_form", "dosage_strength",
                     F.col("therapeutic_class").alias("class"), F.col("regulatory_category").alias("regulatory"),
                     F.col("unit_price").cast("double").alias("price"), F.col("unit_cost").cast("double").alias("cost"),
                     F.col("drug_status").alias("status"), "manufacturer", "drug_key")
            .orderBy("drug_name", "drug_key").limit(n).drop("drug_key"))


def drug_history(star: Star, drug_name: str | None = None) -> DataFrame:
    """SEA-2: per year/month for one drug (all drugs when ``drug_name`` is None, keyed by name)."""
    dr = star["dim_drug"].select("drug_key", "drug_name")
    if drug_name is not None:
        dr = dr.where(F.col("drug_name") == drug_name)
    f = sales(star, None, None, ("calendar_year", "month_num", "month_name")).join(dr, "drug_key", "inner")
    keys = ([] if drug_name is not None else ["drug_name"])
    return (f.groupBy(*keys, F.col("calendar_year").alias("yr"), F.col("month_name").alias("mo"), "month_num")
            .agg(long_sum("units_sold").alias("units"), dbl_sum("net_revenue").alias("rev"),
                 weighted_margin().alias("margin"))
            .orderBy(*keys, "yr", "month_num"))


def drug_stock(star: Star, drug_name: str | None = None) -> DataFrame:
    """SEA-3: per status for one drug (all drugs when ``drug_name`` is None)."""
    dr = star["dim_drug"].select("drug_key", "drug_name")
    if drug_name is not None:
        dr = dr.where(F.col("drug_name") == drug_name)
    keys = ([] if drug_name is not None else ["drug_name"])
    return (star["fact_inventory"].join(dr, "drug_key", "inner")
            .groupBy(*keys, "stock_status")
            .agg(long_sum("units_on_hand").alias("on_hand"), dbl_sum("stock_value").alias("value"))
            .orderBy(*keys, X.stock_severity("stock_status"), "stock_status"))


def customer_lookup(star: Star, text: str | None = None, customer_type: str | None = None,
                    country: str | None = None, n: int = 200) -> DataFrame:
    """SEA-4: left join to geography."""
    c = star["dim_customer"]
    g = star["dim_geography"].select("geography_key", "country_region", "city")
    j = c.join(g, "geography_key", "left")
    if text:
        j = j.where(F.lower(F.col("customer_name")).contains(text.lower()))
    if customer_type:
        j = j.where(F.col("customer_type") == customer_type)
    if country:
        j = j.where(F.col("country_region") == country)
    return (j.select("customer_code", "customer_name", "customer_type", "customer_segment", "email",
                     "payment_terms", "customer_status", "country_region", "city", "customer_key")
            .orderBy("customer_name", "customer_key").limit(n).drop("customer_key"))


def sales_search(star: Star, years: list[int] | None = None, source_system: str | None = None,
                 min_rev: float = 0, max_rev: float = BIG, n: int = 1000) -> DataFrame:
    """SEA-5: newest first; order number and line break ties."""
    f = sales(star, None, None, ("calendar_year",))
    if years:
        f = f.where(F.col("calendar_year").isin(list(years)))
        if "order_year" in f.columns:  # partition pruning on the written fact
            f = f.where(F.col("order_year").isin(list(years)))
    if source_system:
        f = f.where(F.col("source_system") == source_system)
    f = f.where(F.col("net_revenue").between(min_rev, max_rev))
    dr = star["dim_drug"].select("drug_key", "drug_name")
    c = star["dim_customer"].select("customer_key", "customer_name", "customer_type")
    return (f.join(dr, "drug_key", "inner").join(c, "customer_key", "inner")
            .select(F.col("source_order_number").alias("order_no"), F.col("full_date").alias("date"),
                    "drug_name", "customer_name", "customer_type", "units_sold",
                    F.col("unit_price").cast("double").alias("price"),
                    F.col("net_revenue").cast("double").alias("revenue"),
                    F.col("gross_margin_pct").cast("double").alias("margin"), "source_system",
                    "source_order_line_num")
            .orderBy(F.desc("date"), "order_no", "source_order_line_num", "source_system")
            .limit(n).drop("source_order_line_num"))


def picklists(star: Star) -> DataFrame:
    """SEA-6: distinct classes, forms, customer types, countries, years as (list, value)."""
    def one(df, c, name):
        return (df.where(F.col(c).isNotNull()).select(F.lit(name).alias("list"),
                                                      F.col(c).cast("string").alias("value")).distinct())
    u = (one(star["dim_therapeutic_class"], "therapeutic_class", "class")
         .unionByName(one(star["dim_drug"], "dosage_form", "form"))
         .unionByName(one(star["dim_customer"], "customer_type", "customer_type"))
         .unionByName(one(star["dim_geography"], "country_region", "country"))
         .unionByName(one(star["dim_date"], "calendar_year", "year")))
    return u.orderBy("list", "value")


def drug_price_list(star: Star) -> DataFrame:
    """SEA-7."""
    return (star["dim_drug"].select("drug_name", F.col("unit_price").cast("double").alias("unit_price"), "drug_key")
            .orderBy("drug_name", "drug_key").drop("drug_key"))


# -------------------------------------------------------------- reports

def _full_sales(star: Star, start, end, date_cols, drug_cols=("drug_name",), class_cols=("therapeutic_class",),
                cust_cols=("customer_type",)) -> DataFrame:
    f = sales(star, start, end, date_cols)
    c = star["dim_customer"].select("customer_key", *cust_cols)
    return _join_drug_class(f, star, drug_cols, class_cols).join(c, "customer_key", "inner")


def sales_summary(star: Star, start=None, end=None) -> DataFrame:
    """REP-1."""
    f = _full_sales(star, start, end, ("calendar_year", "month_name", "month_num"))
    return (f.groupBy("calendar_year", "month_name", "month_num", "drug_name", "therapeutic_class", "customer_type")
            .agg(long_sum("units_sold").alias("units"), dbl_sum("gross_revenue").alias("gross_rev"),
                 dbl_sum("net_revenue").alias("net_rev"), dbl_sum("gross_profit").alias("profit"),
                 weighted_margin().alias("avg_margin"))
            .orderBy("calendar_year", "month_num", F.desc("net_rev"), "drug_name", "therapeutic_class",
                     "customer_type")
            .select(F.col("calendar_year").alias("year"), F.col("month_name").alias("month"),
                    F.col("drug_name").alias("drug"), F.col("therapeutic_class").alias("class"),
                    F.col("customer_type").alias("cust_type"), "units", "gross_rev", "net_rev", "profit",
                    "avg_margin"))


def inventory_status(star: Star) -> DataFrame:
    """REP-2: mean days of supply ignores nulls."""
    fi = star["fact_inventory"]
    return (_join_drug_class(fi, star, ("drug_code", "drug_name", "dosage_form"))
            .groupBy("drug_code", "drug_name", "dosage_form", F.col("therapeutic_class").alias("class"),
                     "stock_status")
            .agg(long_sum("units_on_hand").alias("on_hand"), long_sum("units_ordered").alias("ordered"),
                 dbl_sum("stock_value").alias("value"), mean("days_of_supply").alias("days_supply"))
            .orderBy("stock_status", "drug_name", "drug_code", "class"))


def customer_revenue(star: Star, start=None, end=None) -> DataFrame:
    """REP-4: inner join customer, left join geography."""
    c = star["dim_customer"].select("customer_key", "customer_name", "customer_type", "customer_segment",
                                    F.col("geography_key").alias("cust_geo"))
    g = star["dim_geography"].select(F.col("geography_key").alias("cust_geo"),
                                     F.col("country_region").alias("country"), "city")
    f = sales(star, start, end).join(c, "customer_key", "inner").join(g, "cust_geo", "left")
    return (f.groupBy("customer_name", "customer_type", "customer_segment", "country", "city")
            .agg(F.count(F.lit(1)).alias("orders"), long_sum("units_sold").alias("units"),
                 dbl_sum("net_revenue").alias("revenue"), weighted_margin().alias("avg_margin"))
            .orderBy(F.desc("revenue"), "customer_name"))


def monthly_revenue(star: Star, start=None, end=None) -> DataFrame:
    """REP-5: drug / class / customer joins act as filters."""
    f = _full_sales(star, start, end, ("calendar_year", "quarter_label", "month_name", "month_num"), (), (), ())
    return (f.groupBy("calendar_year", "quarter_label", "month_name", "month_num")
            .agg(F.count(F.lit(1)).alias("orders"), long_sum("units_sold").alias("units"),
                 dbl_sum("gross_revenue").alias("gross"), dbl_sum("net_revenue").alias("net"),
                 dbl_sum("gross_profit").alias("profit"), weighted_margin().alias("margin"))
            .orderBy("calendar_year", "month_num")
            .select(F.col("calendar_year").alias("year"), F.col("quarter_label").alias("quarter"),
                    F.col("month_name").alias("month"), "orders", "units", "gross", "net", "profit", "margin"))


def drug_performance(star: Star, start=None, end=None) -> DataFrame:
    """REP-6."""
    f = _join_drug_class(sales(star, start, end), star, ("drug_name", "dosage_form", "dosage_strength"))
    return (f.groupBy("drug_name", "dosage_form", "dosage_strength", F.col("therapeutic_class").alias("class"))
            .agg(long_sum("units_sold").alias("units"), dbl_sum("net_revenue").alias("revenue"),
                 dbl_sum("gross_profit").alias("profit"), weighted_margin().alias("avg_margin"),
                 F.countDistinct("customer_key").alias("customers"))
            .orderBy(F.desc("revenue"), "drug_name"))


# ---------------------------------------------------------------- marts

SALES_MART_COLS = [
    "full_date", "calendar_year", "month_name", "quarter_label", "drug_name", "dosage_form", "dosage_strength",
    "therapeutic_class", "therapeutic_subclass", "customer_name", "customer_type", "customer_segment", "city",
    "country_region", "distribution_zone", "territory_name", "territory_group", "units_sold", "unit_price",
    "gross_revenue", "discount_amount", "net_revenue", "cost_of_goods", "gross_profit", "gross_margin_pct",
    "tax_amount", "freight_cost", "source_system",
]


def sales_mart(star: Star) -> DataFrame:
    """MART-1: denormalised sales; date/drug/customer/class inner, geography/territory left."""
    f = star["fact_drug_sales"]
    d = star["dim_date"].select("date_key", "full_date", "calendar_year", "month_name", "quarter_label")
    c = star["dim_customer"].select("customer_key", "customer_name", "customer_type", "customer_segment")
    g = star["dim_geography"].select("geography_key", "city", "country_region", "distribution_zone")
    t = star["dim_sales_territory"].select("territory_key", "territory_name", "territory_group")
    j = _join_drug_class(f.join(d, f.order_date_key == d.date_key, "inner"), star,
                         ("drug_name", "dosage_form", "dosage_strength"), ("therapeutic_class", "therapeutic_subclass"))
    j = (j.join(c, "customer_key", "inner")
         .join(g, "geography_key", "left").join(t, "territory_key", "left"))
    return j.select(*SALES_MART_COLS)


INVENTORY_MART_COLS = [
    "full_date", "calendar_year", "month_name", "quarter_label", "drug_name", "dosage_form", "dosage_strength",
    "therapeutic_class", "units_on_hand", "units_ordered", "units_dispatched", "safety_stock_level",
    "reorder_point", "stock_value", "days_of_supply", "stock_status",
]


def inventory_mart(star: Star) -> DataFrame:
    """MART-2: denormalised inventory, inner joins."""
    fi = star["fact_inventory"]
    d = star["dim_date"].select("date_key", "full_date", "calendar_year", "month_name", "quarter_label")
    return (_join_drug_class(fi.join(d, fi.snapshot_date_key == d.date_key, "inner"), star,
                             ("drug_name", "dosage_form", "dosage_strength"))
            .select(*INVENTORY_MART_COLS))


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-9: write a result as CSV with a header (one folder of part files)."""
    df.write.mode(mode).option("header", True).csv(path)


# ------------------------------------------------- evaluation (timed) queries

def top5_drugs_by_revenue(star: Star) -> DataFrame:
    """Timed query 1."""
    dr = star["dim_drug"].select("drug_key", "drug_name")
    return (star["fact_drug_sales"].join(dr, "drug_key", "inner").groupBy("drug_name")
            .agg(dbl_sum("net_revenue").alias("rev")).orderBy(F.desc("rev"), "drug_name").limit(5))


def revenue_by_year(star: Star) -> DataFrame:
    """Timed query 2."""
    d = star["dim_date"].select("date_key", "calendar_year")
    f = star["fact_drug_sales"]
    return (f.join(d, f.order_date_key == d.date_key, "inner").groupBy("calendar_year")
            .agg(dbl_sum("net_revenue").alias("rev")).orderBy("calendar_year"))


def stock_status_count(star: Star) -> DataFrame:
    """Timed query 3."""
    return star["fact_inventory"].groupBy("stock_status").agg(F.count(F.lit(1)).alias("n"))


def revenue_by_type(star: Star) -> DataFrame:
    """Timed query 4."""
    c = star["dim_customer"].select("customer_key", "customer_type")
    return (star["fact_drug_sales"].join(c, "customer_key", "inner").groupBy("customer_type")
            .agg(dbl_sum("net_revenue").alias("rev")).orderBy(F.desc("rev"), "customer_type"))


def full_fact_scan(star: Star) -> DataFrame:
    """Timed query 5: count, total revenue, mean margin over the whole fact."""
    return star["fact_drug_sales"].agg(F.count(F.lit(1)).alias("rows"), dbl_sum("net_revenue").alias("rev"),
                                       mean("gross_margin_pct").alias("avg_margin"))


TIMED = {
    "q1_top5_drugs": top5_drugs_by_revenue,
    "q2_revenue_by_year": revenue_by_year,
    "q3_stock_status_count": stock_status_count,
    "q4_revenue_by_customer_type": revenue_by_type,
    "q5_full_fact_scan": full_fact_scan,
}
