"""Column-expression helpers.  All of them are built-in Spark expressions, so they
stay inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medistar.functions import fixed

MONEY = T.DecimalType(18, 4)
PCT = T.DecimalType(8, 4)
DAYS = T.DecimalType(10, 2)

_NULLISH = ["nan", "none", "null", ""]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- safe casts

def safe_str(c, default: str | None = "Unknown") -> Column:
    """Trimmed text; null or a null-ish word (nan/none/null/blank) becomes ``default``."""
    s = F.trim(col(c).cast("string"))
    bad = s.isNull() | F.lower(s).isin(_NULLISH)
    return F.when(bad, F.lit(default)).otherwise(s)


def safe_double(c, default: float | None = 0.0) -> Column:
    """Number as double; unparsable, NaN or infinite becomes ``default``."""
    d = F.expr(f"try_cast({_sql(c)} AS DOUBLE)") if isinstance(c, str) else col(c).cast("double")
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.when(bad, F.lit(default).cast("double")).otherwise(d)


def long_key(c: str, schema: T.StructType | None = None) -> Column:
    """64-bit integer of a column: exact where it reads as one, else truncated via
    double ('12.0'); anything else, or out of range, is null and never wraps.
    A column that ``schema`` holds as an integer is widened only, which is the same
    value by far less generated code."""
    q = _sql(c)
    if schema is not None and any(f.name == c and isinstance(f.dataType, T.IntegralType) for f in schema):
        return F.expr(q).cast("long")
    return F.expr(f"coalesce(try_cast({q} AS BIGINT), try_cast(try_cast({q} AS DOUBLE) AS BIGINT))")


def safe_int(c: str, default: int | None = 0, schema: T.StructType | None = None) -> Column:
    """``long_key`` with a default for failures."""
    return F.coalesce(long_key(c, schema), F.lit(default).cast("long"))


def safe_date_key(c: str, default: int | None = None, schema: T.StructType | None = None) -> Column:
    """yyyymmdd key as int; what has more than eight digits is no date key."""
    k = long_key(c, schema)
    return F.when(k.between(-99999999, 99999999), k.cast("int")).otherwise(F.lit(default).cast("int"))


def safe_money(c, default=0) -> Column:
    """Decimal(18,4) amount; unparsable becomes ``default``."""
    if isinstance(c, str):
        d = F.expr(f"try_cast({_sql(c)} AS DECIMAL(18,4))")
    else:
        d = col(c).cast(MONEY)
    return F.coalesce(d, F.lit(default).cast(MONEY))


def money(c) -> Column:
    return col(c).cast(MONEY)


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ------------------------------------------------------------------- lookups

def map_lookup(c, mapping: Mapping, default=None) -> Column:
    """Exact lookup in a literal map (codegen'd, no join); missing -> ``default``."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = m[col(c)]
    return v if default is None else F.coalesce(v, F.lit(default))


def stock_status(units) -> Column:
    """DIM-7: stock band of units on hand (null counts as 0)."""
    u = F.coalesce(col(units), F.lit(0))
    return (F.when(u <= 0, fixed.STOCK_OUT)
            .when(u < fixed.CRITICAL_BELOW, fixed.STOCK_CRITICAL)
            .when(u < fixed.LOW_BELOW, fixed.STOCK_LOW)
            .when(u > fixed.OVERSTOCK_ABOVE, fixed.STOCK_OVER)
            .otherwise(fixed.STOCK_IN))


def stock_severity(status) -> Column:
    s = col(status)
    return F.when(s == fixed.STOCK_OUT, 1).when(s == fixed.STOCK_CRITICAL, 2).otherwise(3)


def zone(country) -> Column:
    return map_lookup(country, fixed.COUNTRY_TO_ZONE, fixed.DEFAULT_ZONE)


def first_match(c, pairs: Sequence[tuple[str, str]], default: str) -> Column:
    """Value of the first (needle, value) pair whose needle occurs in ``c``."""
    s = col(c)
    out = None
    for needle, value in pairs:
        cond = s.contains(needle)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default)


def range_lookup(key, ranges, default):
    """(lo, hi, a, b) inclusive ranges -> struct(a, b); first range wins."""
    k = col(key)
    out = None
    for lo, hi, a, b in ranges:
        v = F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"))
        cond = k.between(lo, hi)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(F.struct(F.lit(default[0]).alias("a"), F.lit(default[1]).alias("b")))


# ----------------------------------------------------------- dates and keys

def date_key(d) -> Column:
    """yyyymmdd integer key of a date/timestamp column."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def shift_key(k, years: int) -> Column:
    """SRC-12: shift a yyyymmdd key by whole years; keys <= 0 are kept as they are."""
    k = col(k)
    return F.when(k > 0, (F.floor(k / 10000) + years) * 10000 + F.pmod(k, F.lit(10000))).otherwise(k).cast("int")


def week_of_year_monday(d) -> Column:
    """Monday-based week number; days before the year's first Monday are week 0."""
    d = col(d)
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


# ------------------------------------------------------------ rule helpers

def reject_reason(rules: Iterable[tuple[Column, str]]) -> Column:
    """First failing rule wins (the cleansing waterfall)."""
    return F.coalesce(*[F.when(cond, F.lit(reason)) for cond, reason in rules], F.lit(None).cast("string"))


def exact_pct(num, den, scale: int) -> Column:
    """round(num / den * 100, scale), half away from zero, computed exactly.

    ``num`` and ``den`` hold at most four decimals.  They are scaled to integers
    and divided with an exact integral quotient, because a DECIMAL division can
    lose digits to precision limits and then round twice.  Null when den is 0.
    Amounts whose scaled integers stay within 64 bits are divided as such.
    """
    def quotient(t):
        nu, du = (F.abs((col(c) * 10000).cast(t)) for c in (num, den))
        return nu * F.lit(2 * 100 * 10 ** scale).cast(t) + du, du * 2

    nu = (col(num) * 10000).cast("decimal(38,0)")
    du = (col(den) * 10000).cast("decimal(38,0)")
    top, bottom = quotient("decimal(38,0)")
    few_n, few_d = quotient("long")
    # the numerator's factor is at most 2e6 (scale 4): 9e18 holds 4e8 * 1e4 * 2e6 and the denominator beside it
    small = (F.abs(col(num)) < F.lit(8 * 10 ** 12 // (2 * 100 * 10 ** scale) * 100)) & (F.abs(col(den)) < F.lit(4 * 10 ** 13))
    q = F.when(small, F.call_function("div", few_n, few_d).cast("decimal(38,0)")) \
        .otherwise(((top - F.pmod(top, bottom)) / bottom).cast("decimal(38,0)"))
    sign = F.when((nu < 0) != (du < 0), F.lit(-1)).otherwise(F.lit(1))
    return F.when(du == 0, F.lit(None)).otherwise(sign * q / F.lit(10 ** scale))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: str = "first",
           count_col: str | None = None, sum_cols: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the first (or last) row in ``order``.

    Implemented as a hash aggregate of ``min``/``max`` over a struct whose
    leading fields are the order columns.  Unlike a ``row_number`` window this
    is combined map-side, so a key holding a large share of the rows never has
    to be gathered into one task.  With ``count_col`` the number of dropped
    duplicates per key is kept.  Rows that are equal in ``order`` are told apart
    by their other columns; an order column given by its name is carried once.
    ``sum_cols`` are summed over all rows of a key instead of picked.
    """
    payload = [c for c in df.columns if c not in keys and c not in sum_cols]
    by_name = {o: f"_o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    fields = [col(o).alias(f"_o{i}") for i, o in enumerate(order)] + [F.col(c) for c in payload if c not in by_name]
    pick = F.min if keep == "first" else F.max
    aggs = [pick(F.struct(*fields)).alias("_r")]
    if count_col:
        aggs.append((F.count(F.lit(1)) - 1).alias(count_col))
    aggs += [F.sum(c).alias(c) for c in sum_cols]
    out = df.groupBy(*keys).agg(*aggs)
    sel = [F.col(k) for k in keys] + [F.col(f"_r.{by_name.get(c, c)}").alias(c) for c in payload] + list(sum_cols)
    if count_col:
        sel.append(F.col(count_col))
    return out.select(*sel).select(*df.columns, *([count_col] if count_col else []))
