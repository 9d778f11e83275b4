"""Build the star schema from raw source tables (SNK-11 run_pipeline).

``build_star`` is one lazy plan: extract -> conform dimensions -> conform facts
-> resolve keys.  ``materialize_star`` writes every table to a warehouse folder
(Parquet) and reads it back, which is what the query layer runs on in
production.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medistar.operators import conform, dims, facts
from medistar.operators.conform import union_all
from medistar.params import Params
from medistar.session import fs_drop, in_slice, release_shuffles, slices_of
from medistar.sources import adapter
from medistar.sources.extract import extract_all

STAR_TABLES = ["dim_date", "dim_geography", "dim_sales_territory", "dim_therapeutic_class",
               "dim_drug", "dim_customer", "fact_drug_sales", "fact_inventory"]
FACT_COLS = {"fact_drug_sales": facts.FACT_SALES_COLS, "fact_inventory": facts.FACT_INVENTORY_COLS}


@dataclass
class Star:
    tables: dict[str, DataFrame]
    report: DataFrame | None = None
    audit: DataFrame | None = None
    extra: dict = field(default_factory=dict)

    def __getitem__(self, k: str) -> DataFrame:
        return self.tables[k]

    def register(self, prefix: str = "") -> None:
        for k, v in self.tables.items():
            v.createOrReplaceTempView(prefix + k)


def conform_dimensions(spark: SparkSession, raw: dict[str, DataFrame], params: Params) -> Star:
    """DIM-1..DIM-6 plus dimension key resolution (SNK-3, SNK-4)."""
    d_date = dims.transform_dim_date(raw["dim_date"])
    d_geo = dims.transform_dim_geography(raw["dim_geography"])
    d_terr = dims.transform_dim_territory(raw["dim_sales_territory"])
    d_cls = dims.transform_dim_therapeutic_class(raw["dim_product_category"], raw["dim_product_subcategory"])
    d_drug = dims.transform_dim_drug(raw["dim_product"], raw["dim_product_subcategory"],
                                     raw["dim_product_category"], params)
    d_cust = dims.transform_dim_customer(raw["dim_customer"])
    cls_keys = d_cls.clean.select(F.col("source_subcategory_key").alias("source_subcat_key"),
                                  F.col("therapeutic_class_key"))
    drug = (d_drug.clean.join(cls_keys, "source_subcat_key", "left")
            .withColumn("therapeutic_class_key", F.coalesce(F.col("therapeutic_class_key"), F.lit(1)))
            .select(*dims.DIM_DRUG_COLS[:6], "therapeutic_class_key", *dims.DIM_DRUG_COLS[6:]))
    geo_keys = d_geo.clean.select(F.col("source_geo_key"), F.col("geography_key"))
    cust = (d_cust.clean.join(geo_keys, "source_geo_key", "left")
            .select(*[c for c in dims.DIM_CUSTOMER_COLS if c != "source_geo_key"], "geography_key"))
    tables = {"dim_date": d_date.clean, "dim_geography": d_geo.clean, "dim_sales_territory": d_terr.clean,
              "dim_therapeutic_class": d_cls.clean, "dim_drug": drug, "dim_customer": cust}
    report = union_all([x.report for x in (d_date, d_geo, d_terr, d_cls, d_drug, d_cust)])
    return Star(tables, report)


def _conform_sales(sales: DataFrame, dim_tables: dict[str, DataFrame], params: Params) -> conform.Conformed:
    return facts.transform_fact_sales(sales, dim_tables["dim_drug"], dim_tables["dim_customer"], dim_tables["dim_date"],
                                      dim_tables["dim_sales_territory"], params)


def conform_facts(raw: dict[str, DataFrame], dim_tables: dict[str, DataFrame], params: Params) -> Star:
    """FACT-1..FACT-5 against (conformed or already written) dimensions."""
    f_sales = _conform_sales(raw["fact_internet_sales"], dim_tables, params)
    f_inv = facts.transform_fact_inventory(raw["fact_product_inventory"], dim_tables["dim_drug"],
                                           dim_tables["dim_date"], params)
    return Star({"fact_drug_sales": f_sales.clean, "fact_inventory": f_inv.clean},
                union_all([f_sales.report, f_inv.report]))


def transform_all(spark: SparkSession, raw: dict[str, DataFrame], params: Params) -> Star:
    d = conform_dimensions(spark, raw, params)
    f = conform_facts(raw, d.tables, params)
    return Star({**d.tables, **f.tables}, d.report.unionByName(f.report))


def build_star(spark: SparkSession, raw: dict[str, DataFrame], params: Params | None = None) -> Star:
    params = params or Params()
    return transform_all(spark, extract_all(spark, raw, params), params)


def star_from_driver(spark: SparkSession, sf_dir: str, params: Params | None = None) -> Star:
    """The star built from the driver's TPC-H-style tables through the adapter."""
    return build_star(spark, adapter.load_driver_raw(spark, sf_dir), params)


def write_table(df: DataFrame, name: str, path: str, mode: str = "overwrite",
                counts: dict | None = None) -> DataFrame:
    """Write one star table as Parquet and return it read back.

    Facts are stored partitioned by year, so date-range queries prune
    directories at planning time, and sorted by (year, date key) inside each
    task, so every file's row groups carry tight min/max statistics.  No extra
    shuffle: the rows keep the partitioning of the job that produced them (the
    dedupe), each task writing one file per year it holds.  With ``counts`` the
    row count of the written files is recorded.
    """
    out = df
    part = None
    if name in facts.PARTITION_COLS:
        part, key = facts.PARTITION_COLS[name]
        out = df.sortWithinPartitions(part, key)
    w = out.write.mode(mode).option("compression", "zstd")
    if part:
        w = w.partitionBy(part)
    w.parquet(f"{path}/{name}")
    written = df.sparkSession.read.parquet(f"{path}/{name}").select(*df.columns)
    if counts is not None:
        counts[name] = written.count()
    return written


def write_counted(tracker: conform.Tracker, name: str, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a fact with its counts (``conform.Counted``) and take the counts from what was written."""
    rows = tracker.counted[name].rows
    write_table(rows, name, path, mode)
    return _take_counts(tracker, name, path)


def _take_counts(tracker: conform.Tracker, name: str, path: str) -> DataFrame:
    """Count a written fact (all its slices) and drop the removed rows' partition; return the fact read back."""
    rows = tracker.counted[name].rows
    read = rows.sparkSession.read.schema(rows.schema)
    tracker.count(name, read.parquet(f"{path}/{name}"))
    part, _ = facts.PARTITION_COLS[name]
    fs_drop(rows.sparkSession, f"{path}/{name}/{part}=__HIVE_DEFAULT_PARTITION__")
    return read.parquet(f"{path}/{name}").select(*FACT_COLS[name])


def materialize_star(star: Star, path: str, mode: str = "overwrite") -> Star:
    """Write every star table under ``path`` and return the star read back."""
    out = {name: write_table(df, name, path, mode) for name, df in star.tables.items()}
    return Star(out, star.report, star.audit, dict(star.extra))


def _write_all(tables: dict[str, DataFrame], path: str, mode: str, counts: dict,
               tracker: conform.Tracker) -> dict[str, DataFrame]:
    """Write independent tables as concurrent Spark jobs (their stages share the
    cluster instead of running back to back)."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        futures = {name: pool.submit(write_counted, tracker, name, path, mode) if name in tracker.counted
                   else pool.submit(write_table, df, name, path, mode, counts) for name, df in tables.items()}
        return {name: fut.result() for name, fut in futures.items()}


def _write_dimensions(spark: SparkSession, ex: dict[str, DataFrame], path: str, params: Params, mode: str,
                      counts: dict) -> tuple[dict[str, DataFrame], conform.Tracker]:
    with conform.tracking() as tracker:
        d = conform_dimensions(spark, ex, params)
    return _write_all(d.tables, path, mode, counts, tracker), tracker


def build_dimensions_to(spark: SparkSession, raw: dict[str, DataFrame], path: str, params: Params | None = None,
                        mode: str = "overwrite") -> dict[str, DataFrame]:
    """The star's dimensions, written as ``build_star_to`` writes them: no dimension depends on a fact."""
    params = params or Params()
    written, tracker = _write_dimensions(spark, extract_all(spark, raw, params), path, params, mode, {})
    tracker.drop(spark)
    return written


def _write_sliced(spark: SparkSession, ex: dict[str, DataFrame], dim_tables: dict[str, DataFrame], path: str, params: Params,
                  mode: str, slices: int, tracker: conform.Tracker) -> dict[str, DataFrame]:
    """The facts one after the other, the sales in slices of their order numbers: an order line and its repeats are
    in one slice, and what a slice shuffles is deleted before the next."""
    out = {"fact_inventory": write_counted(tracker, "fact_inventory", path, mode)}
    for i in range(slices):
        release_shuffles(spark)
        one = ex["fact_internet_sales"].where(in_slice(i, slices, F.trim(F.col("SalesOrderNumber").cast("string"))))
        with conform.tracking(count_facts=True) as part:
            _conform_sales(one, dim_tables, params)
        write_table(part.counted["fact_drug_sales"].rows, "fact_drug_sales", path, "append" if i else mode)
    out["fact_drug_sales"] = _take_counts(tracker, "fact_drug_sales", path)
    return out


def build_star_to(spark: SparkSession, raw: dict[str, DataFrame], path: str, params: Params | None = None,
                  mode: str = "overwrite", slices: int | None = None) -> Star:
    """Extract, conform and write the star in load order: the dimensions are
    written first and the facts are conformed against the written dimensions,
    so no dimension plan is recomputed inside the fact jobs.  Large sales are
    conformed in ``slices`` (default: by the size of the input files)."""
    params = params or Params()
    ex = extract_all(spark, raw, params)
    counts: dict[str, int] = {}
    written, tracker = _write_dimensions(spark, ex, path, params, mode, counts)
    with conform.tracking(count_facts=True) as fact_tracker:
        f = conform_facts(ex, written, params)
    release_shuffles(spark)
    slices = slices or slices_of(ex["fact_internet_sales"])
    written.update(_write_all(f.tables, path, mode, counts, fact_tracker) if slices == 1 else
                   _write_sliced(spark, ex, written, path, params, mode, slices, fact_tracker))
    release_shuffles(spark)
    tracker.rows.extend(fact_tracker.rows)
    report = tracker.report(spark, counts)
    report.write.mode(mode).parquet(f"{path}/_report")
    tracker.drop(spark)
    return Star(written, spark.read.parquet(f"{path}/_report"))


def read_star(spark: SparkSession, path: str) -> Star:
    """A star written by ``build_star_to`` (tables, plus its removal report)."""
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in STAR_TABLES}
    for name in facts.PARTITION_COLS:
        tables[name] = tables[name].select(*FACT_COLS[name])
    return Star(tables, spark.read.parquet(f"{path}/_report"))
