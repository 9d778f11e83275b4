"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` is the
registry of implemented operators/queries, each ``(spark, sf_dir) ->
DataFrame`` over the whole driver tables; ``oracle_sql()`` gives, per key, an
independent DuckDB statement that rebuilds the star from the same parquet
views and computes the same result.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medistar.operators import facts as FACTS
from medistar.operators import outcomes
from medistar.operators import uploads as U
from medistar.operators.upsert import insert_ignore, merge_upsert
from medistar.params import Params
from medistar.plans import monitor as M
from medistar.plans import quality as DQ
from medistar.plans import queries as Q
from medistar.plans.star import STAR_TABLES, Star, build_dimensions_to, build_star_to, read_star
from medistar.plans.pipeline import load_upload
from medistar.plans.warehouse import UPLOAD_INVENTORY_UPDATE, Warehouse, load_all
from medistar.session import configure, fs_exists, fs_fingerprint, fs_read_text, fs_write_text, shared_path
from medistar.sources import adapter, raw
from medistar.sources.extract import extract_all, extract_summary

try:  # the training-data operators and their pipeline are an optional part
    import corpus_pipeline
    from medistar.llm import queries as LLM
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "medistar.llm"):
        raise
    corpus_pipeline = LLM = None

SMOKE_DIR = "/root/testdata/sf0.001"
PARAMS = Params()

_STARS: dict[tuple, Star] = {}
_DIMENSIONS: dict[tuple, dict] = {}
_LOCK = threading.RLock()
_DRIVER: dict[tuple, dict] = {}
# three batches on three days: the first load, a reload with changes, the day's uploads
BATCHES = [PARAMS.with_(batch_id=name, once=True, batch_clock=f"2025-06-{day} 06:00:00")
           for name, day in [("FIRST_LOAD", 28), ("RELOAD", 29), ("UPLOADS", 30)]]
_HISTORY: dict[tuple, dict] = {}
_STAGED: dict[tuple, DataFrame] = {}
UPLOAD_SNAPSHOT_DATE = "2025-06-01"
ADHOC_TEXT = ("-- status mix of the drug dimension\n"
              "SELECT drug_status, dosage_form, COUNT(*) AS n FROM dim_drug GROUP BY drug_status, dosage_form;")
ADHOC_PAGE_TEXT = "SELECT drug_key, drug_name FROM dim_drug ORDER BY drug_key LIMIT 500 OFFSET 5"


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    # a stopped and recreated session may reuse id(); the application id differs
    return (id(spark), spark.sparkContext.applicationId, sf_dir)


def _tables(spark: SparkSession, sf_dir: str) -> dict:
    key = _key(spark, sf_dir)
    if key not in _DRIVER:
        configure(spark)
        _DRIVER[key] = adapter.read_driver_tables(spark, sf_dir)
    return _DRIVER[key]


def _extracted(spark: SparkSession, sf_dir: str) -> dict:
    return extract_all(spark, adapter.driver_raw(spark, _tables(spark, sf_dir)), PARAMS)


def _code_digest() -> str:
    """Hash of the library source: a star written by other code is never reused."""
    root = os.path.dirname(os.path.abspath(__file__))
    h = hashlib.sha1()
    for d, _, files in sorted(os.walk(os.path.join(root, "medistar"))):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:16]


def _star(spark: SparkSession, sf_dir: str) -> Star:
    """The star built from the driver tables, written once (in load order) under
    the shared checkpoint folder; queries read the written tables.  A star
    published by an earlier process for the same input files (paths, sizes,
    modification times), parameters and code is reused (the marker is written
    last, after every table is complete)."""
    key = _key(spark, sf_dir)
    with _LOCK:
        return _star_locked(spark, sf_dir, key)


def _star_locked(spark: SparkSession, sf_dir: str, key: tuple) -> Star:
    if key not in _STARS:
        configure(spark)
        base = shared_path(spark, "registry_star", _ident(spark, sf_dir))
        marker = f"{base}/_PUBLISHED"
        if fs_exists(spark, marker):
            _STARS[key] = read_star(spark, f"{base}/{fs_read_text(spark, marker).strip()}")
        else:
            run = uuid.uuid4().hex
            star = build_star_to(spark, adapter.driver_raw(spark, _tables(spark, sf_dir)), f"{base}/{run}", PARAMS)
            fs_write_text(spark, marker, run)
            _STARS[key] = star
    return _STARS[key]


def _dimensions(spark: SparkSession, sf_dir: str) -> dict:
    """The dimensions for a query that reads no fact: the star's if it is there, else written without the facts."""
    key = _key(spark, sf_dir)
    with _LOCK:
        base = shared_path(spark, "registry_star", _ident(spark, sf_dir))
        if key in _STARS or fs_exists(spark, f"{base}/_PUBLISHED"):
            return _star(spark, sf_dir).tables
        if key not in _DIMENSIONS:
            raw_tables = adapter.driver_raw(spark, _tables(spark, sf_dir))
            _DIMENSIONS[key] = build_dimensions_to(spark, raw_tables, f"{base}/dimensions-{uuid.uuid4().hex}", PARAMS)
        return _DIMENSIONS[key]


def _ident(spark: SparkSession, sf_dir: str) -> str:
    inputs = fs_fingerprint(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in adapter.DRIVER_TABLES])
    return hashlib.sha1(f"{sf_dir}|{inputs}|{PARAMS!r}|{_code_digest()}".encode()).hexdigest()[:20]


def _history(spark: SparkSession, sf_dir: str) -> dict:
    """A warehouse that has loaded the three batches; batches that it holds already are not loaded again."""
    key = _key(spark, sf_dir)
    with _LOCK:
        if key not in _HISTORY:
            star = _star(spark, sf_dir)
            wh = Warehouse(spark, shared_path(spark, "registry_history", _ident(spark, sf_dir)))
            load_all(wh, star, BATCHES[0])
            summary = load_all(wh, Star(adapter.changed_star(star.tables)), BATCHES[1])
            t = _tables(spark, sf_dir)
            reports = [load_upload(adapter.sales_upload(t, star.tables, PARAMS.shift_years), "sales", wh, BATCHES[2]),
                       load_upload(adapter.inventory_upload(t, star.tables, UPLOAD_SNAPSHOT_DATE), "inventory", wh, BATCHES[2])]
            _HISTORY[key] = {"warehouse": wh, "reload": summary, "reports": reports}
    return _HISTORY[key]


def upload_report(spark, sf_dir):
    """What became of every row of the two uploads."""
    a, b = (r["outcomes"] for r in _history(spark, sf_dir)["reports"])
    return a.unionByName(b)


def upload_inventory_rejects(spark, sf_dir):
    """The whole rows of the inventory upload that were kept out, with their reason."""
    rows = _history(spark, sf_dir)["warehouse"].rejects(BATCHES[2].batch_id).where("upload = 'inventory'")
    cols = ["drug_name", "snapshot_date", "units_on_hand", "units_ordered", "units_dispatched", "unit_cost"]
    fields = F.from_json("record", ", ".join(f"{c} string" for c in cols))
    return rows.withColumn("f", fields).select("outcome", "reason", *[F.col(f"f.{c}").alias(c) for c in cols])


def _audit(spark, sf_dir) -> DataFrame:
    return _history(spark, sf_dir)["warehouse"].audit_log()


def _scan(name: str):
    """A scan of a written source table; a table is written when it is scanned first."""
    def run(spark, sf_dir):
        path = shared_path(spark, "registry_source", _ident(spark, sf_dir))
        with _LOCK:
            if not fs_exists(spark, f"{path}/_DONE_{name}"):
                adapter.write_source_layer(spark, _tables(spark, sf_dir), path, [name])
                fs_write_text(spark, f"{path}/_DONE_{name}", "")
        return raw.scan(spark, name, path=path)
    return run


def scan_categories(spark, sf_dir):
    """SRC-6: both category scans, with the products of each subcategory."""
    cat, sub, prod = (_scan(n)(spark, sf_dir) for n in ["dim_product_category", "dim_product_subcategory", "dim_product"])
    n = prod.groupBy("ProductSubcategoryKey").agg(F.count(F.lit(1)).alias("products"))
    return sub.join(cat, "ProductCategoryKey").join(n, "ProductSubcategoryKey").select(
        "ProductCategoryKey", "CategoryName", "ProductSubcategoryKey", "SubcategoryName", "products")


def _sales_upload(spark, sf_dir):
    st = _star(spark, sf_dir)
    return st, adapter.sales_upload(_tables(spark, sf_dir), st.tables, PARAMS.shift_years)


def upload_sales_clean(spark, sf_dir):
    up = adapter.sales_upload(_tables(spark, sf_dir), _dimensions(spark, sf_dir), PARAMS.shift_years)
    return U.transform_sales_upload(up).clean.drop("_row")


def _sales_staged(spark, sf_dir) -> tuple[Star, DataFrame]:
    """The sales upload cleansed and resolved, written once for the queries over it."""
    key = _key(spark, sf_dir)
    with _LOCK:
        if key not in _STAGED:
            st, up = _sales_upload(spark, sf_dir)
            _STAGED[key] = outcomes.stage(up, "sales", st.tables, PARAMS)
    return _star(spark, sf_dir), _STAGED[key]


def _sales_facts(spark, sf_dir) -> tuple[Star, DataFrame, DataFrame]:
    st, staged = _sales_staged(spark, sf_dir)
    return st, *U.sales_facts(staged.where("outcome is null").drop("outcome", "reason", "record"), st.tables, PARAMS)


def upload_sales_rejects(spark, sf_dir):
    _, staged = _sales_staged(spark, sf_dir)
    return staged.where("outcome is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def upload_sales_insert(spark, sf_dir):
    st, facts, _ = _sales_facts(spark, sf_dir)
    return insert_ignore(st["fact_drug_sales"], facts, outcomes.SALES_KEY, [F.col("_row")]).select(*FACTS.FACT_SALES_COLS)


def _inventory_upload(spark, sf_dir):
    st = _star(spark, sf_dir)
    inv = adapter.inventory_upload(_tables(spark, sf_dir), st.tables, UPLOAD_SNAPSHOT_DATE)
    return st, U.transform_inventory_upload(inv)


def upload_inventory_merge(spark, sf_dir):
    st, tr = _inventory_upload(spark, sf_dir)
    facts, skipped = U.resolve_inventory_upload(tr.clean, st.tables, PARAMS)
    merged = merge_upsert(st["fact_inventory"], facts, ["snapshot_date_key", "drug_key"], list(UPLOAD_INVENTORY_UPDATE))
    return merged.drop("_batch_rows")


def _first_drug(star: Star) -> str:
    """The drug a single-drug search runs for: the first name in name order (one scalar)."""
    return star["dim_drug"].agg(F.min("drug_name")).first()[0]


def _q(fn: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_star(spark, sf_dir))


def _adhoc(spark, sf_dir, text: str) -> DataFrame:
    """A text that reads dimensions only runs on them, any other on the star."""
    some = M.tables_used(spark, M.guard_sql(text)) & {t for t in STAR_TABLES if not t.startswith("dim_")}
    return M.adhoc_sql(spark, _star(spark, sf_dir) if some else Star(_dimensions(spark, sf_dir)), text)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top drugs by revenue over the star built from sf0.001."""
    return Q.top_drugs(_star(spark, SMOKE_DIR), n=5)


def _last_year():
    return Q.preset_range("Last Year", PARAMS.as_of_date)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # dashboard / analytics
        "kpi_summary": _q(lambda s: Q.kpi_summary(s)),
        "kpi_summary_last_year": _q(lambda s: Q.kpi_summary(s, *_last_year())),
        "kpi_by_preset": _q(lambda s: Q.kpi_by_preset(s, PARAMS.as_of_date)),
        "calendar_activity": _q(Q.calendar_activity),
        "class_activity": _q(Q.class_activity),
        "kpi_insights": _q(lambda s: Q.kpi_insights(s)),
        "stock_risk_counts": _q(Q.stock_risk_counts),
        "monthly_trend": _q(lambda s: Q.monthly_trend(s)),
        "top_drugs": _q(lambda s: Q.top_drugs(s, 5)),
        "revenue_by_customer_type": _q(lambda s: Q.revenue_by_customer_type(s)),
        "revenue_by_class": _q(lambda s: Q.revenue_by_class(s)),
        "class_share": _q(lambda s: Q.class_share(s)),
        "stock_status_summary": _q(Q.stock_status_summary),
        "drug_matrix": _q(lambda s: Q.drug_matrix(s, 25)),
        "revenue_by_country": _q(lambda s: Q.revenue_by_country(s)),
        "revenue_by_year_yoy": _q(lambda s: Q.revenue_by_year_yoy(s)),
        "quarterly": _q(lambda s: Q.quarterly(s)),
        "revenue_by_weekday": _q(lambda s: Q.revenue_by_weekday(s)),
        "inventory_movement": _q(lambda s: Q.inventory_movement(s)),
        "stock_alerts": _q(Q.stock_alerts),
        "stock_alert_counts": _q(Q.stock_alert_counts),
        "revenue_by_segment": _q(lambda s: Q.revenue_by_segment(s)),
        "top_customers": _q(lambda s: Q.top_customers(s, 20)),
        "revenue_by_zone": _q(lambda s: Q.revenue_by_zone(s)),
        "top_drugs_dashboard": _q(lambda s: Q.top_drugs(s, 8)),
        "revenue_by_class_top5": _q(lambda s: Q.revenue_by_class(s, n=5)),
        "drug_matrix_dashboard": _q(lambda s: Q.drug_matrix(s, 40, with_form=False)),
        "monthly_trend_last_6_months": _q(lambda s: Q.monthly_trend(
            s, *Q.preset_range("Last 6 Months", PARAMS.as_of_date))),
        # search
        "drug_lookup": _q(lambda s: Q.drug_lookup(s, text="cillin")),
        "drug_history": _q(lambda s: Q.drug_history(s)),
        "drug_stock": _q(lambda s: Q.drug_stock(s)),
        "drug_history_one": _q(lambda s: Q.drug_history(s, _first_drug(s))),
        "drug_stock_one": _q(lambda s: Q.drug_stock(s, _first_drug(s))),
        "customer_lookup": _q(lambda s: Q.customer_lookup(s, customer_type="Clinic")),
        "customer_lookup_text": _q(lambda s: Q.customer_lookup(s, text="household", country="France")),
        "drug_lookup_filtered": _q(lambda s: Q.drug_lookup(s, therapeutic_class="Antibiotics", form="Tablet")),
        "sales_search": _q(lambda s: Q.sales_search(s, years=[2022, 2023], source_system="AW_INTERNET",
                                                    min_rev=1000, max_rev=50000)),
        "picklists": _q(Q.picklists),
        "drug_price_list": _q(Q.drug_price_list),
        # reports and marts
        "sales_summary": _q(lambda s: Q.sales_summary(s)),
        "inventory_status": _q(Q.inventory_status),
        "customer_revenue": _q(lambda s: Q.customer_revenue(s)),
        "monthly_revenue": _q(lambda s: Q.monthly_revenue(s)),
        "drug_performance": _q(lambda s: Q.drug_performance(s)),
        "sales_mart": _q(Q.sales_mart),
        "inventory_mart": _q(Q.inventory_mart),
        # conformed star tables (calendar, dimension and fact operators)
        **{t: lambda spark, sf, t=t: _dimensions(spark, sf)[t] for t in STAR_TABLES if t.startswith("dim_")},
        **{t: _q(lambda s, t=t: s[t]) for t in ["fact_drug_sales", "fact_inventory"]},
        "removal_report": _q(lambda s: s.report),
        "extract_summary": lambda spark, sf: extract_summary(_extracted(spark, sf)),
        # data quality
        "dq_checks": _q(DQ.dq_checks),
        "dq_score": _q(lambda s: DQ.dq_score(DQ.dq_checks(s))),
        "monitor_checks": _q(DQ.monitor_checks),
        "post_load_checks": _q(DQ.post_load_checks),
        "null_profile": _q(DQ.null_profile),
        "reconciliation": lambda spark, sf: DQ.reconciliation(
            _star(spark, sf), DQ.source_counts(extract_summary(_extracted(spark, sf)))),
        # monitoring
        "source_system_breakdown": _q(M.source_system_breakdown),
        "financial_metrics": _q(M.financial_metrics),
        "sales_date_range": _q(M.sales_date_range),
        "critical_drugs": _q(lambda s: M.critical_drugs(s, 10)),
        "row_counts": _q(lambda s: M.row_counts(s)),
        "schema_summary": _q(M.schema_summary),
        "adhoc_sql": lambda spark, sf: _adhoc(spark, sf, ADHOC_TEXT),
        "adhoc_sql_limit": lambda spark, sf: _adhoc(spark, sf, ADHOC_PAGE_TEXT),
        "schema_columns": _q(M.schema_columns),
        # loads: three batches written to a warehouse, and their ledger
        "load_summary_reload": lambda spark, sf: _history(spark, sf)["reload"],
        "etl_audit_first_load": lambda spark, sf: _audit(spark, sf).where(F.col("batch_id") == BATCHES[0].batch_id),
        "etl_audit_log": _audit,
        "recent_etl_runs": lambda spark, sf: M.recent_etl_runs(_audit(spark, sf), 30),
        "etl_timeline": lambda spark, sf: M.etl_timeline(_audit(spark, sf)),
        # scans of a written source layer
        "scan_geography": _scan("dim_geography"),
        "scan_territory": _scan("dim_sales_territory"),
        "scan_categories": scan_categories,
        "scan_product": _scan("dim_product"),
        "scan_customer": _scan("dim_customer"),
        "scan_internet_sales": _scan("fact_internet_sales"),
        "scan_product_inventory": _scan("fact_product_inventory"),
        # daily uploads
        "upload_sales_clean": upload_sales_clean,
        "upload_sales_rejects": upload_sales_rejects,
        "upload_new_customers": lambda spark, sf: _sales_facts(spark, sf)[2],
        "upload_sales_insert": upload_sales_insert,
        "upload_inventory_clean": lambda spark, sf: _inventory_upload(spark, sf)[1].clean.drop("_ord"),
        "upload_inventory_merge": upload_inventory_merge,
        "upload_inventory_rejects": upload_inventory_rejects,
        "upload_report": upload_report,
        **(LLM.queries() if LLM else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


def oracle_sql() -> dict[str, str]:
    from duck_oracle import SQL, star_ctes

    prefix, known = star_ctes(PARAMS), queries()
    sql = {k: prefix + v for k, v in SQL.items() if k in known}
    if LLM:
        sql.update(LLM.oracle_sql())
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
