"""DIM-1..DIM-8: conform the six dimensions.

Every transform is a cleansing waterfall: rules are tested in order, the first
failing rule removes the row and is counted under its reason.  Surrogate keys
equal the (unique, integer) business keys, so keying needs no global ordering
and a reload keeps every key stable.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.functions import fixed
from medistar.operators.conform import Conformed, duplicate_report, flag, track, union_all, waterfall_report
from medistar.params import Params

INT = "int"


_try_int = X.long_key  # business keys are 64-bit end to end


def _nan_text(c: str, default: str):
    """Trimmed text where null / 'nan' becomes ``default`` (other text is kept)."""
    s = F.trim(F.col(c).cast("string"))
    return F.when(s.isNull() | (s == "nan"), F.lit(default)).otherwise(s)


def _all_cols_order(df: DataFrame, *first):
    """By ``first``, then by all columns (what ``dedupe`` orders by beyond the columns it is given)."""
    return list(first)


# ------------------------------------------------------------------ dim_date

DIM_DATE_COLS = ["date_key", "full_date", "calendar_year", "calendar_quarter", "calendar_month",
                 "month_name", "month_abbr", "month_num", "day_of_month", "day_of_week", "day_name",
                 "week_of_year", "quarter_num", "quarter_label", "is_weekend", "fiscal_year",
                 "fiscal_quarter"]


def transform_dim_date(raw: DataFrame) -> Conformed:
    n = lambda c: F.expr(f"try_cast(`{c}` AS DOUBLE)")
    out = raw.select(
        n("DateKey").alias("date_key"),
        F.to_date(F.col("FullDateAlternateKey")).alias("full_date"),
        n("CalendarYear").alias("calendar_year"),
        n("CalendarQuarter").alias("calendar_quarter"),
        n("CalendarMonth").alias("calendar_month"),
        _nan_text("EnglishMonthName", "Unknown").alias("month_name"),
        _nan_text("MonthAbbr", "UNK").alias("month_abbr"),
        n("MonthNumberOfYear").alias("month_num"),
        n("DayNumberOfMonth").alias("day_of_month"),
        n("DayNumberOfWeek").alias("day_of_week"),
        _nan_text("EnglishDayNameOfWeek", "Unknown").alias("day_name"),
        n("WeekNumberOfYear").alias("week_of_year"),
        n("CalendarQuarter").alias("quarter_num"),
        F.concat(F.lit("Q"), F.col("CalendarQuarter").cast("string"), F.lit(" "),
                 F.col("CalendarYear").cast("string")).alias("quarter_label"),
        F.coalesce(F.col("IsWeekend").cast("boolean"), F.lit(False)).alias("is_weekend"),
        n("FiscalYear").alias("fiscal_year"),
        n("FiscalQuarter").alias("fiscal_quarter"),
    )
    flagged, reasons = flag(out, [
        (F.col("date_key").isNull() | F.col("full_date").isNull(), "null_date_key_or_full_date"),
        (~F.coalesce(F.col("calendar_year").between(2000, 2035), F.lit(False)), "year_out_of_range"),
        (~F.coalesce(F.col("calendar_month").between(1, 12), F.lit(False)), "invalid_month"),
        (~F.coalesce(F.col("calendar_quarter").between(1, 4), F.lit(False)), "invalid_quarter"),
    ])
    flagged = track(flagged, "dim_date", reasons)
    ints = ["calendar_year", "calendar_quarter", "calendar_month", "month_num", "day_of_month",
            "day_of_week", "week_of_year", "quarter_num", "fiscal_year", "fiscal_quarter"]
    kept = flagged.where(F.col("_reason").isNull()).drop("_reason")
    for c in ints:
        kept = kept.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast(INT))
    kept = kept.withColumn("date_key", F.col("date_key").cast(INT))
    deduped = X.dedupe(kept, ["date_key"], [F.col("full_date")], "first", count_col="_dups")
    report = union_all(waterfall_report(flagged, "dim_date") + [duplicate_report(deduped, "dim_date")])
    return Conformed(deduped.drop("_dups").select(*DIM_DATE_COLS), report)


# ------------------------------------------------------------- dim_geography

def transform_dim_geography(raw: DataFrame) -> Conformed:
    """DIM-2."""
    country = _nan_text("CountryRegion", "Unknown")
    out = raw.select(
        _try_int("GeographyKey").alias("source_geo_key"),
        _nan_text("City", "Unknown").alias("city"),
        _nan_text("StateProvinceName", "").alias("state_province"),
        country.alias("country_region"),
        _nan_text("PostalCode", "").alias("postal_code"),
        F.lit("Urban").alias("region_type"),
        X.zone(country).alias("distribution_zone"),
    )
    flagged, reasons = flag(out, [
        (F.col("source_geo_key").isNull(), "null_geo_key"),
        (F.col("country_region") == "Unknown", "unknown_country"),
    ])
    flagged = track(flagged, "dim_geography", reasons)
    kept = flagged.where(F.col("_reason").isNull()).drop("_reason")
    # Unicode-aware \w like the original (Java's \w is ASCII unless (?U))
    for c in ["city", "state_province"]:
        kept = kept.withColumn(c, F.trim(F.regexp_replace(c, r"(?U)[^\w\s\-]", "")))
    deduped = X.dedupe(kept, ["source_geo_key"], _all_cols_order(kept), "first", count_col="_dups")
    clean = deduped.drop("_dups").select(F.col("source_geo_key").alias("geography_key"), *kept.columns)
    report = union_all(waterfall_report(flagged, "dim_geography") + [duplicate_report(deduped, "dim_geography")])
    return Conformed(clean, report)


# ------------------------------------------------------- dim_sales_territory

def transform_dim_territory(raw: DataFrame) -> Conformed:
    """DIM-3."""
    def txt(c):
        s = F.trim(F.col(c).cast("string"))
        return F.when(s.isNull() | (s == "nan") | (s == ""), F.lit("Unknown")).otherwise(s)

    out = raw.select(
        _try_int("SalesTerritoryKey").alias("source_territory_key"),
        txt("TerritoryName").alias("territory_name"),
        txt("TerritoryCountry").alias("territory_country"),
        txt("TerritoryGroup").alias("territory_group"),
    )
    unknown = ((F.col("territory_name") == "Unknown") & (F.col("territory_country") == "Unknown")
               & (F.col("territory_group") == "Unknown"))
    flagged, reasons = flag(out, [
        (F.col("source_territory_key").isNull(), "null_territory_key"),
        (unknown, "all_fields_unknown"),
    ])
    flagged = track(flagged, "dim_sales_territory", reasons)
    kept = flagged.where(F.col("_reason").isNull()).drop("_reason")
    deduped = X.dedupe(kept, ["source_territory_key"], _all_cols_order(kept), "first", count_col="_dups")
    clean = deduped.drop("_dups").select(F.col("source_territory_key").alias("territory_key"), *kept.columns)
    report = union_all(waterfall_report(flagged, "dim_sales_territory")
                       + [duplicate_report(deduped, "dim_sales_territory")])
    return Conformed(clean, report)


# ----------------------------------------------------- dim_therapeutic_class

def _categories(cat: DataFrame) -> DataFrame:
    c = cat.select(_try_int("ProductCategoryKey").alias("ck"),
                   X.safe_str("CategoryName", "").alias("cat_name")).where(F.col("ck").isNotNull())
    return X.dedupe(c, ["ck"], [F.col("cat_name")], "first")


def transform_dim_therapeutic_class(cat: DataFrame, subcat: DataFrame) -> Conformed:
    """DIM-4."""
    s = subcat.select(_try_int("ProductSubcategoryKey").alias("sk"),
                      _try_int("ProductCategoryKey").alias("ck"),
                      X.safe_str("SubcategoryName", "").alias("name"))
    j = s.join(_categories(cat), "ck", "left")
    flagged, reasons = flag(j, [
        (F.col("sk").isNull() | F.col("ck").isNull(), "null_keys"),
        (F.col("name") == "", "blank_subcategory_name"),
        (F.coalesce(F.col("cat_name"), F.lit("")) == "", "unknown_category"),
    ])
    flagged = track(flagged, "dim_therapeutic_class", reasons)
    kept = flagged.where(F.col("_reason").isNull())
    cls = X.map_lookup("cat_name", {k: v[0] for k, v in fixed.CATEGORY_TO_CLASS.items()}, fixed.DEFAULT_CLASS[0])
    code = X.map_lookup("cat_name", {k: v[1] for k, v in fixed.CATEGORY_TO_CLASS.items()}, fixed.DEFAULT_CLASS[1])
    atc = X.map_lookup("cat_name", {k: v[2] for k, v in fixed.CATEGORY_TO_CLASS.items()}, fixed.DEFAULT_CLASS[2])
    out = kept.select(
        F.col("ck").alias("source_category_key"),
        F.col("sk").alias("source_subcategory_key"),
        code.alias("class_code"),
        cls.alias("therapeutic_class"),
        F.coalesce(X.map_lookup("name", fixed.SUBCATEGORY_TO_SUBCLASS), F.col("name")).alias("therapeutic_subclass"),
        X.map_lookup(cls, fixed.CLASS_TO_REGULATORY, fixed.DEFAULT_REGULATORY).alias("regulatory_category"),
        atc.alias("atc_code"),
    )
    deduped = X.dedupe(out, ["source_subcategory_key"], _all_cols_order(out), "first", count_col="_dups")
    clean = deduped.drop("_dups").select(F.col("source_subcategory_key").alias("therapeutic_class_key"),
                                         *out.columns)
    report = union_all(waterfall_report(flagged, "dim_therapeutic_class")
                       + [duplicate_report(deduped, "dim_therapeutic_class")])
    return Conformed(clean, report)


# ------------------------------------------------------------------ dim_drug

def _names_map():
    return F.create_map(*[x for k, v in fixed.DRUG_NAMES.items()
                          for x in (F.lit(k), F.array(*[F.lit(n) for n in v]))])


def generic_name(sub_name, key):
    """DIM-5a: the name list of the subcategory (fallback list otherwise), indexed by key mod length."""
    lst = F.coalesce(_names_map()[X.col(sub_name)], _names_map()[F.lit(fixed.FALLBACK_NAME_LIST)])
    return F.element_at(lst, (F.pmod(X.col(key), F.size(lst)) + 1).cast("int"))


def unique_names(df: DataFrame, base: str = "base_name", key: str = "source_product_key",
                 code: str = "_code") -> DataFrame:
    """DIM-5b, set-based.  In key order, the first row with a base name keeps it;
    later rows take ``base (CODE)`` unless an earlier row already took that exact
    name, then ``base [key]``.

    Per base name only the minimum key matters, and among the others the
    minimum key per (base, code).  Both lookups are aggregates whose size is
    bounded by the fixed vocabulary (name lists x strengths x forms, x 10 codes),
    not by the data, so they are safe to broadcast.
    """
    first = df.groupBy(base).agg(F.min(key).alias("_first_key"))
    j = df.join(F.broadcast(first), base, "left")
    later = j.where(F.col(key) != F.col("_first_key"))
    first_code = later.groupBy(base, code).agg(F.min(key).alias("_first_code_key"))
    j = j.join(F.broadcast(first_code), [base, code], "left")
    name = (F.when(F.col(key) == F.col("_first_key"), F.col(base))
            .when(F.col(key) == F.col("_first_code_key"), F.concat(F.col(base), F.lit(" ("), F.col(code), F.lit(")")))
            .otherwise(F.concat(F.col(base), F.lit(" ["), F.col(key).cast("string"), F.lit("]"))))
    return j.withColumn("drug_name", name).drop("_first_key", "_first_code_key")


DIM_DRUG_COLS = ["drug_key", "source_product_key", "drug_code", "drug_name", "dosage_form", "dosage_strength",
                 "source_subcat_key", "unit_price", "unit_cost", "standard_cost", "manufacturer", "drug_status"]


def transform_dim_drug(prod: DataFrame, subcat: DataFrame, cat: DataFrame, params: Params) -> Conformed:
    """DIM-5 (names DIM-5a/5b, code DIM-5c)."""
    sub = subcat.select(_try_int("ProductSubcategoryKey").alias("sub_key"),
                        _try_int("ProductCategoryKey").alias("cat_key"),
                        X.safe_str("SubcategoryName", "General").alias("sub_name")
                        ).where(F.col("sub_key").isNotNull() & F.col("cat_key").isNotNull())
    sub = X.dedupe(sub, ["sub_key"], [F.col("cat_key"), F.col("sub_name")], "last")
    cats = cat.select(_try_int("ProductCategoryKey").alias("cat_key"),
                      X.safe_str("CategoryName", "General").alias("cat_name")).where(F.col("cat_key").isNotNull())
    cats = X.dedupe(cats, ["cat_key"], [F.col("cat_name")], "last")

    price_raw = F.expr("try_cast(ListPrice AS DECIMAL(18,4))")
    p = prod.select(
        _try_int("ProductKey").alias("pk"),
        X.safe_str("ProductName", "").alias("pname"),
        price_raw.alias("price"),
        X.safe_money("StandardCost", 0).alias("cost_raw"),
        F.expr("try_cast(DealerPrice AS DECIMAL(18,4))").alias("dealer_raw"),
        _try_int("ProductSubcategoryKey").alias("sub_key"),
        F.col("Color").cast("string").alias("color"),
        F.col("Size").cast("string").alias("size"),
        F.trim(F.col("Status").cast("string")).alias("status"),
    )
    flagged, reasons = flag(p, [
        (F.col("pk").isNull(), "null_product_key"),
        (F.col("pname") == "", "null_product_name"),
        (F.col("price").isNull() | (F.col("price") <= 0), "zero_or_null_price"),
    ])
    price = F.col("price")
    cost0 = F.greatest(F.col("cost_raw"), F.lit(0).cast(X.MONEY))
    anomalous = cost0 > price * 3
    flagged = flagged.withColumn("_cost_fixed", anomalous)
    flagged = track(flagged, "dim_drug", reasons, {"anomalous_cost_fixed": F.col("_cost_fixed")})
    kept = flagged.where(F.col("_reason").isNull())
    kept = (kept.join(sub, "sub_key", "left").join(cats, "cat_key", "left")
            .withColumn("sub_name", F.coalesce(F.col("sub_name"), F.lit(fixed.FALLBACK_NAME_LIST)))
            .withColumn("cat_name", F.coalesce(F.col("cat_name"), F.lit(fixed.FALLBACK_NAME_LIST))))
    form = X.map_lookup("color", fixed.COLOR_TO_FORM, fixed.DEFAULT_FORM)
    strength = X.map_lookup("size", fixed.SIZE_TO_STRENGTH, fixed.DEFAULT_STRENGTH)
    atc = X.map_lookup("cat_name", {k: v[2] for k, v in fixed.CATEGORY_TO_CLASS.items()}, fixed.DEFAULT_CLASS[2])
    codes = F.array(*[F.lit(c) for c in fixed.NAME_SUFFIX_CODES])
    dealer = F.coalesce(F.col("dealer_raw"), price)
    shaped = kept.select(
        F.col("pk").alias("source_product_key"),
        # DIM-5c: first letter of the ATC group + "-" + key padded to 4 (format, not lpad: no truncation)
        F.concat(F.substring(atc, 1, 1), F.lit("-"), F.format_string("%04d", F.col("pk"))).alias("drug_code"),
        F.trim(F.concat_ws(" ", generic_name("sub_name", "pk"), strength, form)).alias("base_name"),
        form.alias("dosage_form"),
        strength.alias("dosage_strength"),
        F.col("sub_key").alias("source_subcat_key"),
        F.round(price, 4).cast(X.MONEY).alias("unit_price"),
        F.when(F.col("_cost_fixed"), F.round(price * F.lit(Decimal("0.70")), 4))
         .otherwise(F.round(cost0, 4)).cast(X.MONEY).alias("unit_cost"),
        F.round(F.when(dealer <= 0, price).otherwise(dealer), 4).cast(X.MONEY).alias("standard_cost"),
        F.lit(params.manufacturer).alias("manufacturer"),
        F.when(F.col("status") == "0", "Discontinued").otherwise("Active").alias("drug_status"),
        F.element_at(codes, (F.pmod(F.col("pk"), F.lit(len(fixed.NAME_SUFFIX_CODES))) + 1).cast("int")).alias("_code"),
    )
    shaped = X.dedupe(shaped, ["source_product_key"], _all_cols_order(shaped), "first", count_col="_dups")
    named = unique_names(shaped)
    clean = named.select(F.col("source_product_key").alias("drug_key"), *DIM_DRUG_COLS[1:])
    report = union_all(waterfall_report(flagged, "dim_drug", fixes={"anomalous_cost_fixed": F.col("_cost_fixed")})
                       + [duplicate_report(shaped, "dim_drug")])
    return Conformed(clean, report)


# -------------------------------------------------------------- dim_customer

DIM_CUSTOMER_COLS = ["customer_key", "source_customer_key", "customer_code", "customer_name", "customer_type",
                     "email", "phone", "payment_terms", "customer_segment", "customer_status",
                     "source_geo_key"]


def customer_type_segment(key):
    """DIM-6 range lookup: customer key range -> struct(a=type, b=segment)."""
    return X.range_lookup(key, fixed.CUSTOMER_KEY_RANGES, fixed.DEFAULT_CUSTOMER_TYPE)


def customer_display_name(full, ctype, key):
    first_word = F.split(X.col(full), r"\s+").getItem(0)
    suffix = X.map_lookup(ctype, fixed.CUSTOMER_NAME_SUFFIX, fixed.DEFAULT_CUSTOMER_NAME_SUFFIX)
    return F.substring(F.concat(first_word, F.lit(" "), suffix, F.lit(" #"), X.col(key).cast("string")), 1, 200)


def transform_dim_customer(cust: DataFrame) -> Conformed:
    full = F.trim(F.concat(X.safe_str("FirstName", ""), F.lit(" "), X.safe_str("LastName", "")))
    c = cust.select(
        _try_int("CustomerKey").alias("ck"),
        full.alias("full"),
        X.safe_str("EmailAddress", "").alias("email_raw"),
        X.safe_str("Phone", "").alias("phone_raw"),
        _try_int("GeographyKey").alias("source_geo_key"),
    )
    flagged, reasons = flag(c, [
        (F.col("ck").isNull(), "null_customer_key"),
        ((F.col("full") == "") | (F.col("full") == "Unknown Unknown"), "null_name"),
    ])
    bad_email = (F.col("email_raw") != "") & ~F.col("email_raw").contains("@")
    flagged = flagged.withColumn("_email_fixed", bad_email)
    flagged = track(flagged, "dim_customer", reasons, {"invalid_email_fixed": F.col("_email_fixed")})
    kept = flagged.where(F.col("_reason").isNull())
    ts = customer_type_segment(F.col("ck"))
    kept = kept.withColumn("_ts", ts)
    out = kept.select(
        F.col("ck").alias("source_customer_key"),
        F.format_string(fixed.CUSTOMER_CODE_FORMAT, F.col("ck")).alias("customer_code"),
        customer_display_name("full", F.col("_ts.a"), "ck").alias("customer_name"),
        F.col("_ts.a").alias("customer_type"),
        F.when(F.col("_email_fixed") | (F.col("email_raw") == "") | (F.col("email_raw") == "Unknown"),
               F.lit(None).cast("string")).otherwise(F.col("email_raw")).alias("email"),
        F.when((F.col("phone_raw") == "") | (F.col("phone_raw") == "Unknown"),
               F.lit(None).cast("string")).otherwise(F.col("phone_raw")).alias("phone"),
        F.lit(fixed.PAYMENT_TERMS).alias("payment_terms"),
        F.col("_ts.b").alias("customer_segment"),
        F.lit(fixed.CUSTOMER_STATUS).alias("customer_status"),
        F.col("source_geo_key"),
    )
    deduped = X.dedupe(out, ["source_customer_key"], _all_cols_order(out), "first", count_col="_dups")
    clean = deduped.drop("_dups").select(F.col("source_customer_key").alias("customer_key"), *out.columns)
    report = union_all(waterfall_report(flagged, "dim_customer",
                                        fixes={"invalid_email_fixed": F.col("_email_fixed")})
                       + [duplicate_report(deduped, "dim_customer")])
    return Conformed(clean, report)
