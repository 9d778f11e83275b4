"""UPL-1..UPL-8: daily upload transforms and set-based key resolution.

Uploads arrive as all-string columns (CSV).  Cleansing is a waterfall with a
reject reason, measures are DECIMAL expressions, and every lookup the original
did row by row (drug by name, customer by name, geography, territory, date)
is a join over the distinct values of the batch.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.functions import fixed
from medistar.operators import facts as FACTS
from medistar.operators.keys import assign_sequential_keys
from medistar.operators.matching import first_match_key
from medistar.params import Params
from medistar.session import shared_path

# tried in order; one- and two-digit parts, month before day unless that is no month
DATE_FORMATS = ["yyyy-M-d", "yyyy/M/d", "yyyy-M-d H:m[:s]", "yyyy-M-d'T'H:m[:s][.SSS][X]", "yyyy/M/d H:m[:s]",
                "M-d-yyyy", "M/d/yyyy", "M/d/yyyy H:m[:s]", "d-M-yyyy", "d/M/yyyy", "d/M/yyyy H:m[:s]",
                "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd"]


def _shape(fmt: str) -> str:
    """A pattern that every text of the format matches (others may too): a text that cannot be of a format
    is not parsed by it, as a failing parse costs many times a passing one."""
    n, out = r"[+-]?\d+", fmt.split("'T'")[0].split("[")[0]
    for part, rx in (("yyyyMMdd", "#"), ("yyyy", "~"), ("MMMM", "@"), ("MMM", "@"), ("M", "#"), ("d", "#"), ("H", "#"), ("m", "#")):
        out = out.replace(part, rx)
    out = out.replace("~", r"[+-]?\d{4,}").replace("@", r"\D+").replace("#", n)
    return f"^{out}$" if out.count(n) and "[" not in fmt else f"^{out}"


def parse_date(c) -> F.Column:
    """Lenient date parse (the first format that fits); unparsable -> null.
    A time of day is dropped; an ISO offset counts towards the day in UTC."""
    s = F.trim(X.col(c).cast("string"))
    return F.coalesce(*[F.when(s.rlike(_shape(f)), F.to_date(F.try_to_timestamp(s, F.lit(f)))) for f in DATE_FORMATS])


def num(c) -> F.Column:
    """pandas ``to_numeric(errors='coerce').fillna(0)`` as DECIMAL(18,4)."""
    return F.coalesce(F.expr(f"try_cast(trim(`{c}`) AS DECIMAL(18,4))"), F.lit(0).cast(X.MONEY))


@dataclass
class UploadResult:
    clean: DataFrame
    rejects: DataFrame  # rows with a reject reason


def _split(flagged: DataFrame) -> UploadResult:
    return UploadResult(flagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
                        flagged.where(F.col("reject_reason").isNotNull()))


# ------------------------------------------------------------------ UPL-1..3

def upload_customer_type(c) -> F.Column:
    """UPL-2: first keyword contained in the lower-cased type, default Hospital."""
    return X.first_match(F.lower(F.trim(X.col(c).cast("string"))), fixed.UPLOAD_CUSTOMER_TYPES,
                         fixed.DEFAULT_UPLOAD_CUSTOMER_TYPE)


def upload_zone(c) -> F.Column:
    return X.map_lookup(F.lower(X.col(c).cast("string")),
                        {k.lower(): v for k, v in fixed.COUNTRY_TO_ZONE.items()}, fixed.DEFAULT_ZONE)


def flag_sales_upload(df: DataFrame) -> DataFrame:
    """UPL-1/UPL-3: every row cleansed, with its reject reason (null: good)."""
    # what later columns use is a column of its own, so that it is parsed or computed once a row
    df = df.withColumn("_text_date", F.trim(F.col("order_date").cast("string")))
    if "_d" not in df.columns:
        df = df.withColumn("_d", parse_date("_text_date"))
    df = df.withColumns({"_units": num("units_sold"), "_price": num("unit_price"),
                         "_pct": num("unit_price_discount_pct"),
                         "_cogs_raw": F.greatest(num("total_product_cost"), F.lit(0).cast(X.MONEY))})
    d, units, price, pct, cogs_raw = (F.col(c) for c in ("_d", "_units", "_price", "_pct", "_cogs_raw"))
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    flagged = df.withColumn("reject_reason", X.reject_reason([
        (d.isNull(), "bad_dates"),
        (units <= 0, "zero_units"),
        (price <= 0, "zero_price"),
        (blank("drug_name") | blank("customer_name"), "null_critical"),
    ]))
    gross, disc, net, cogs, profit = (F.col(c) for c in ("_gross", "_disc", "_net", "_cogs", "_profit"))
    flagged = flagged.withColumn("_gross", F.round(price * units, 4))
    flagged = flagged.withColumns({
        "_disc": F.round(gross * pct * F.lit(Decimal("0.01")), 4),
        "_cogs": F.round(F.when(cogs_raw < gross * F.lit(Decimal("0.5")), cogs_raw * units).otherwise(cogs_raw), 4)})
    flagged = flagged.withColumn("_net", F.round(gross - disc, 4))
    flagged = flagged.withColumn("_profit", F.round(net - cogs, 4))
    out = flagged.select(
        F.trim("drug_name").alias("drug_name"),
        F.trim("customer_name").alias("customer_name"),
        upload_customer_type("customer_type").alias("customer_type"),
        d.alias("order_date"),
        units.alias("units_sold"), price.alias("unit_price"), pct.alias("unit_price_discount_pct"),
        gross.cast(X.MONEY).alias("gross_revenue"), disc.cast(X.MONEY).alias("discount_amount"),
        net.cast(X.MONEY).alias("net_revenue"), cogs.cast(X.MONEY).alias("cost_of_goods"),
        profit.cast(X.MONEY).alias("gross_profit"),
        F.when(net > 0, X.exact_pct(profit, net, 2)).otherwise(F.lit(0)).cast(X.PCT).alias("gross_margin_pct"),
        F.round(num("tax_amt"), 4).cast(X.MONEY).alias("tax_amount"),
        F.round(num("freight"), 4).cast(X.MONEY).alias("freight_cost"),
        F.trim("sales_territory_name").alias("sales_territory_name"),
        F.trim("country_region").alias("country_region"),
        F.trim("city").alias("city"),
        upload_zone(F.trim("country_region")).alias("distribution_zone"),
        X.date_key(d).alias("date_key"),
        *[F.col(c) for c in ("_row", "_raw", "_ck", "record", "drug_key", "outcome", "reason") if c in df.columns],
        "reject_reason",
    )
    return out


# new customers of a batch: up to here their names are broadcast to the rows
FEW_NAMES = 100_000
# the raw columns that a cleansed sales row is made of
SALES_UPLOAD_COLS = ["drug_name", "customer_name", "customer_type", "order_date", "units_sold", "unit_price", "unit_price_discount_pct",
                     "total_product_cost", "tax_amt", "freight", "sales_territory_name", "country_region", "city"]


def transform_sales_upload(df: DataFrame) -> UploadResult:
    """UPL-1/UPL-3, split."""
    return _split(flag_sales_upload(df))


# ----------------------------------------------------------------- UPL-4

def flag_inventory_upload(df: DataFrame, order_col: str = "_row") -> DataFrame:
    """UPL-4: every row cleansed, with its reject reason (null: good).  Days of supply uses the
    mean dispatched per raw drug name over the file's good rows, repeats included."""
    base = df.withColumn("_d", parse_date("snapshot_date")).withColumn("reject_reason", X.reject_reason([
        (F.col("_d").isNull(), "bad_dates"),
        (F.coalesce(F.trim(F.col("drug_name")), F.lit("")) == "", "null_critical"),
    ]))
    at_least_0 = lambda c: F.greatest(num(c), F.lit(0).cast(X.MONEY)).alias(c)
    m = base.select(F.when(F.col("reject_reason").isNull(), F.col("drug_name")).alias("_raw_name"),
                    F.trim("drug_name").alias("drug_name"), F.col("_d").alias("snapshot_date"), at_least_0("units_on_hand"),
                    at_least_0("units_ordered"), at_least_0("units_dispatched"), num("unit_cost").alias("unit_cost"),
                    F.col(order_col).alias("_ord"), *[F.col(c) for c in ("record", "drug_key") if c in df.columns], "reject_reason")
    # group mean (combined map-side) joined back, instead of a window over a possibly hot drug;
    # on_hand / mean = on_hand * count / sum, kept exact in DECIMAL until the final rounding
    means = m.where("_raw_name is not null").groupBy("_raw_name").agg(
        F.sum("units_dispatched").alias("_sum_d"), F.count("units_dispatched").alias("_cnt_d"))
    m = m.join(means, "_raw_name", "left")
    return m.select(
        "drug_name", "snapshot_date",
        F.col("units_on_hand").cast("long").alias("units_on_hand"),
        F.col("units_ordered").cast("long").alias("units_ordered"),
        F.col("units_dispatched").cast("long").alias("units_dispatched"),
        F.round(F.col("units_on_hand") * F.col("unit_cost"), 4).cast(X.MONEY).alias("stock_value"),
        F.when(F.col("_sum_d") > 0, F.round(F.col("units_on_hand") * F.col("_cnt_d") / F.col("_sum_d"), 2))
         .cast(X.DAYS).alias("days_of_supply"),
        X.stock_status(F.col("units_on_hand").cast("long")).alias("stock_status"),
        X.date_key("snapshot_date").alias("date_key"),
        "_ord", *[F.col(c) for c in ("record", "drug_key") if c in df.columns], "reject_reason",
    )


def transform_inventory_upload(df: DataFrame, order_col: str = "_row") -> UploadResult:
    """UPL-4, split: the last good row per (drug, date), and the rejected rows.  The repeats
    are reported by ``outcomes.judge_inventory``."""
    res = _split(flag_inventory_upload(df, order_col))
    return UploadResult(X.dedupe(res.clean, ["drug_name", "date_key"], [F.col("_ord")], "last"), res.rejects)


# ----------------------------------------------------------------- UPL-5..7

def _look_up(rows: DataFrame, name_col: str, lname: Column, pattern: Column, dim: DataFrame, dim_col: str, key_col: str,
             out_col: str) -> DataFrame:
    """``rows`` with ``out_col``: the smallest key of a ``dim`` row whose lower-cased name is ``lname``, else of one whose
    name contains ``pattern`` (both of the column ``_name_``, a row's name).  Each name is looked up once and the
    names found are written, so that the rows meet one narrow table by their name as it is."""
    spark = rows.sparkSession
    exact = dim.groupBy(F.lower(dim_col).alias("_lname")).agg(F.min(key_col).alias("_exact"))
    path = shared_path(spark, "names", uuid.uuid4().hex)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    each = rows.select(F.col(name_col).alias("_name_")).where("_name_ is not null").distinct()
    each = written(each.withColumn("_lname", lname).join(exact, "_lname", "left").select("_name_", "_exact"), "each")
    misses = each.where("_exact is null").withColumn("_pattern", pattern)
    found = first_match_key(misses, "_pattern", dim, dim_col, key_col, "_found")
    known = written(each.withColumn("_pattern", pattern).join(found, "_pattern", "left").select(
        "_name_", F.coalesce("_exact", "_found").alias(out_col)).where(F.col(out_col).isNotNull()), "known")
    return rows.join(known, F.col(name_col) == F.col("_name_"), "left").drop("_name_")


def resolve_drug(rows: DataFrame, dim_drug: DataFrame, name_col: str = "drug_name") -> DataFrame:
    """UPL-5: exact case-insensitive name, else any drug whose name contains the
    first token; the smallest key wins (the original took an unordered LIMIT 1)."""
    return _look_up(rows.drop("drug_key"), name_col, F.lower("_name_"), F.split(F.trim("_name_"), r"\s+").getItem(0),
                    dim_drug, "drug_name", "drug_key", "drug_key")


def resolve_by_lower_name(rows: DataFrame, dim: DataFrame, row_col: str, dim_col: str, key_col: str,
                          out_col: str) -> DataFrame:
    """UPL-7: case-insensitive equality, smallest key; nullable result (no fan-out)."""
    m = dim.groupBy(F.lower(F.col(dim_col)).alias("_l")).agg(F.min(key_col).alias(out_col))
    return rows.withColumn("_l", F.lower(F.col(row_col))).join(m, "_l", "left").drop("_l")


def _cut(c: str, n: int | None) -> Column:
    return F.substring(F.col(c), 1, n) if n else F.col(c)


def match_customers(rows: DataFrame, dim_customer: DataFrame, params: Params, name_col: str = "customer_name") -> DataFrame:
    """``rows`` with ``_ck``, the customer of the dimension that their name stands for (see ``resolve_customers``)."""
    return _look_up(rows, name_col, F.lower(_cut("_name_", params.customer_name_chars)), _cut("_name_", params.customer_match_chars),
                    dim_customer, "customer_name", "customer_key", "_ck")


def resolve_customers(rows: DataFrame, dim_customer: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """UPL-6: exact case-insensitive full name first, then any customer whose name
    contains the uploaded one, the smallest key each; unmatched names become new
    customers with source key max(existing, floor) + rank.  Returns (rows with
    customer_key, new dimension rows).  Exact names first make a replay resolve
    every name to the customer that the first load created.

    ``params.customer_match_chars`` / ``customer_name_chars`` / ``customer_type_chars``
    cut what is matched and stored (default: nothing is cut).

    Deviation: names new in this batch match each other by exact lower-cased
    name only (the original's row-by-row inserts could also match prefixes).
    """
    name = _cut("customer_name", params.customer_name_chars)
    r = rows if "_ck" in rows.columns else match_customers(rows, dim_customer, params)
    r = r.withColumn("_lname", F.lower(name))
    miss = r.where(F.col("_ck").isNull())
    new_names = miss.groupBy("_lname").agg(
        F.min(name).alias("customer_name"),
        F.min(_cut("customer_type", params.customer_type_chars)).alias("customer_type"))
    start = dim_customer.agg(F.greatest(F.coalesce(F.max("source_customer_key"), F.lit(params.new_customer_key_floor)),
                                        F.lit(params.new_customer_key_floor)).alias("s"))
    keyed = assign_sequential_keys(new_names, ["_lname"], start, "source_customer_key")
    new_dim = keyed.select(
        F.col("source_customer_key").alias("customer_key"), "source_customer_key",
        F.format_string(fixed.CUSTOMER_CODE_FORMAT, F.col("source_customer_key")).alias("customer_code"),
        "customer_name", "customer_type",
        F.lit(None).cast("string").alias("email"), F.lit(None).cast("string").alias("phone"),
        F.lit(fixed.PAYMENT_TERMS).alias("payment_terms"),
        F.lit(fixed.UPLOAD_CUSTOMER_SEGMENT).alias("customer_segment"),
        F.lit(fixed.CUSTOMER_STATUS).alias("customer_status"),
        F.lit(None).cast("long").alias("geography_key"), "_lname")
    # pin the numbering: the dimension rows and the fact rows must see the same keys
    new_dim = new_dim.checkpoint(eager=True)
    names = new_dim.select("_lname", F.col("customer_key").alias("_new_ck"))
    # broadcast if they are few: the rows then stay where they are
    names = F.broadcast(names) if names.count() <= FEW_NAMES else names
    r = (r.join(names, "_lname", "left")
         .withColumn("customer_key", F.coalesce("_ck", "_new_ck"))
         .drop("_ck", "_lname", "_new_ck"))
    return r, new_dim.drop("_lname")


# ----------------------------------------------------------------- UPL-8

def _fixed4(c) -> F.Column:
    """Text with exactly four decimals (what ``'%.4f'`` prints for an amount with at most four)."""
    return X.col(c).cast(X.MONEY).cast("string")


def upload_order_number(date_key, drug_key, customer_key, units, price, net) -> F.Column:
    """'UP-' + upper(first 20 hex digits of sha1(date|drug|customer|units|price.4f|net.4f))."""
    src = F.concat_ws("|", X.col(date_key).cast("string"), X.col(drug_key).cast("string"),
                      X.col(customer_key).cast("string"), X.col(units).cast("long").cast("string"),
                      _fixed4(price), _fixed4(net))
    return F.concat(F.lit("UP-"), F.upper(F.substring(F.sha1(src), 1, 20)))


def mark_skipped(clean: DataFrame, star_tables: dict) -> DataFrame:
    """Drug (unless the rows have theirs) and date resolution of cleansed rows: ``drug_key`` and, where one
    is missing, ``skip_reason``."""
    r = clean if "drug_key" in clean.columns else resolve_drug(clean, star_tables["dim_drug"])
    # no broadcast hint: the stored calendar's size is measured at run time
    dates = star_tables["dim_date"].select(F.col("date_key").alias("_dk")).distinct()
    r = r.join(dates, F.col("date_key") == F.col("_dk"), "left")
    return r.withColumn("skip_reason", X.reject_reason([
        (F.col("drug_key").isNull(), "Drug not found"),
        (F.col("_dk").isNull(), "Date not in dim_date"),
    ])).drop("_dk")


def split_skipped(clean: DataFrame, star_tables: dict) -> tuple[DataFrame, DataFrame]:
    """(skipped rows with reason, the others with their drug_key)."""
    r = mark_skipped(clean, star_tables)
    return r.where(F.col("skip_reason").isNotNull()), r.where(F.col("skip_reason").isNull()).drop("skip_reason")


def resolve_sales_upload(clean: DataFrame, star_tables: dict, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Key resolution of cleansed sales-upload rows.

    Returns (fact rows ready to insert-or-ignore, skipped rows with reason,
    new customer dimension rows).
    """
    skipped, ok = split_skipped(clean, star_tables)
    facts, new_customers = sales_facts(ok, star_tables, params)
    return facts, skipped, new_customers


def sales_facts(ok: DataFrame, star_tables: dict, params: Params) -> tuple[DataFrame, DataFrame]:
    """Rows with their drug -> (fact rows, new customer dimension rows)."""
    ok, new_customers = resolve_customers(ok, star_tables["dim_customer"], params)
    ok = resolve_by_lower_name(ok, star_tables["dim_geography"], "country_region", "country_region",
                               "geography_key", "geography_key")
    ok = resolve_by_lower_name(ok, star_tables["dim_sales_territory"], "sales_territory_name", "territory_name",
                               "territory_key", "territory_key")
    facts = ok.select(
        F.col("date_key").alias("order_date_key"),
        F.lit(None).cast("int").alias("ship_date_key"), F.lit(None).cast("int").alias("due_date_key"),
        "drug_key", "customer_key", "geography_key", "territory_key",
        upload_order_number("date_key", "drug_key", "customer_key", "units_sold", "unit_price",
                            "net_revenue").alias("source_order_number"),
        F.lit(1).cast("long").alias("source_order_line_num"),
        F.lit(params.upload_source_system).alias("source_system"),
        F.col("units_sold").cast("long").alias("units_sold"),
        F.col("unit_price").cast(X.MONEY).alias("unit_price"),
        F.col("unit_price_discount_pct").cast(X.PCT).alias("unit_price_discount_pct"),
        "gross_revenue", "discount_amount", "net_revenue", "cost_of_goods", "gross_profit", "gross_margin_pct",
        "tax_amount", "freight_cost",
        F.lit(params.batch_id).alias("etl_batch_id"),
        FACTS.year_of("date_key").alias("order_year"),
        *([F.col("_row")] if "_row" in ok.columns else []),
    )
    return facts, new_customers


def resolve_inventory_upload(clean: DataFrame, star_tables: dict, params: Params) -> tuple[DataFrame, DataFrame]:
    """Drug and date resolution of cleansed inventory-upload rows -> (fact rows, skipped rows)."""
    skipped, ok = split_skipped(clean, star_tables)
    # two upload names resolving to one drug: the later file row wins
    facts = X.dedupe(inventory_facts(ok, params), ["snapshot_date_key", "drug_key"], [F.col("_ord")], "last").drop("_ord")
    return facts, skipped


def inventory_facts(ok: DataFrame, params: Params) -> DataFrame:
    """Rows with their drug -> fact rows, with their place in the file (``_ord``)."""
    return ok.select(
        F.col("date_key").alias("snapshot_date_key"), "drug_key", "units_on_hand", "units_ordered",
        "units_dispatched", F.lit(0).alias("safety_stock_level"), F.lit(0).alias("reorder_point"),
        "stock_value", "days_of_supply", "stock_status", F.lit(params.batch_id).alias("etl_batch_id"),
        FACTS.year_of("date_key").alias("snapshot_year"), "_ord")
