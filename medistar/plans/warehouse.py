"""The warehouse sink: Parquet tables under one root folder (SNK-1..SNK-10).

Layout: a load writes a new folder ``{root}/{table}/load=NNNNN/`` (facts: with
one folder per year in it) and never touches an older one.  The table is what
its pointer file ``{root}/{table}/_current/NNNNNNNN.json`` lists: the folders of
its rows, the schema, and the record of the load that made it.  A load ends with
writing the next pointer; until then, and if it fails midway, readers see the
version before.  A dimension load lists its own folder, a whole snapshot; a fact
load adds its year folders, or puts them in the place of the years it rewrote.
Old folders stay readable until ``vacuum``.

A load that names its batch is safe to replay: the pointer remembers the batch,
and a batch that is in the table already is not loaded again.  Counts come from
grouped aggregates over written rows.  Where a v2 table format with ``MERGE
INTO`` is available, ``merge_upsert`` maps onto it one to one.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from dataclasses import asdict, dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medistar.operators.facts import FACT_INVENTORY_COLS, FACT_SALES_COLS, PARTITION_COLS
from medistar.operators.upsert import dedupe_batch, merge_upsert
from medistar.params import Params
from medistar.plans.star import STAR_TABLES, Star
from medistar.session import fs_create_text, fs_drop, fs_names, fs_read_text, release_shuffles, shared_path

AUDIT_SCHEMA = T.StructType([
    T.StructField("audit_id", T.LongType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("pipeline_step", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("completed_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DecimalType(10, 3)),
])


# column order of the partitioned facts (Parquet discovery puts partition columns last)
TABLE_COLUMNS = {"fact_drug_sales": FACT_SALES_COLS, "fact_inventory": FACT_INVENTORY_COLS}


@dataclass(frozen=True)
class TableSpec:
    keys: tuple[str, ...]
    update_cols: tuple[str, ...] | None  # None = insert or ignore


# SNK-2a: conflict keys and the columns replaced on conflict
TABLE_SPECS = {
    "dim_date": TableSpec(("date_key",), None),
    "dim_geography": TableSpec(("source_geo_key",), ("city", "country_region", "distribution_zone")),
    "dim_sales_territory": TableSpec(("source_territory_key",), ("territory_name", "territory_country")),
    "dim_therapeutic_class": TableSpec(("source_subcategory_key",), ("therapeutic_class", "therapeutic_subclass")),
    "dim_drug": TableSpec(("source_product_key",), ("drug_name", "unit_price", "unit_cost", "drug_status")),
    "dim_customer": TableSpec(("source_customer_key",), ("customer_name", "customer_type", "customer_segment")),
    "fact_drug_sales": TableSpec(("source_order_number", "source_order_line_num", "source_system"), None),
    "fact_inventory": TableSpec(("snapshot_date_key", "drug_key"),
                                ("units_on_hand", "units_ordered", "units_dispatched", "stock_value", "stock_status")),
}
# uploads replace two more inventory columns than the batch load does
UPLOAD_INVENTORY_UPDATE = ("units_on_hand", "units_ordered", "units_dispatched", "stock_value", "days_of_supply",
                           "stock_status", "etl_batch_id")


@dataclass
class LoadResult:
    """read = inserted + updated + kept (in the table with equal values) + skipped (repeats in the
    batch, and rows that an insert-or-ignore found in the table)."""
    table: str
    read: int
    inserted: int
    updated: int
    skipped: int
    kept: int = 0


class ConcurrentLoad(RuntimeError):
    """Another load switched the table's pointer first; nothing of this one is visible."""


def batch_key(batch: str, step: str = "load") -> str:
    return hashlib.sha1(f"{batch}|{step}".encode()).hexdigest()


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ layout
    def _pointers(self, table: str) -> list[str]:
        return [n for n in fs_names(self.spark, f"{self.root}/{table}/_current") if n.endswith(".json") and n[0] != "."]

    def state(self, table: str) -> dict | None:
        """The pointer's content: version, dirs, schema, record."""
        names = self._pointers(table)
        return json.loads(fs_read_text(self.spark, f"{self.root}/{table}/_current/{names[-1]}")) if names else None

    def exists(self, table: str) -> bool:
        return bool(self._pointers(table))

    def folders(self, table: str) -> list[str]:
        """Paths of the folders that hold the table's rows."""
        return [f"{self.root}/{table}/{d}" for d in (self.state(table) or {"dirs": []})["dirs"]]

    def read(self, table: str) -> DataFrame:
        st = self.state(table)
        if st is None:
            raise FileNotFoundError(f"table {table} has no committed version under {self.root}")
        schema = T.StructType.fromJson(json.loads(st["schema"]))
        if not st["dirs"]:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(
            *[f"{self.root}/{table}/{d}" for d in st["dirs"]])
        return rows.select(*schema.names)

    def star(self) -> Star:
        return Star({t: self.read(t) for t in STAR_TABLES if self.exists(t)})

    def _new_folder(self, table: str) -> str:
        used = [int(n[5:]) for n in fs_names(self.spark, f"{self.root}/{table}") if n.startswith("load=")]
        return f"load={max(used, default=0) + 1:05d}"  # past what a failed load left

    def _save(self, table: str, df: DataFrame) -> list[str]:
        """Write rows to a new folder; the folders (facts: one a year) that hold them, relative to the table.

        Facts are sorted by (year, date key) inside each task: one file per year per task, tight
        row-group statistics, no extra shuffle."""
        name = self._new_folder(table)
        path = f"{self.root}/{table}/{name}"
        if table not in PARTITION_COLS:
            df.write.option("compression", "zstd").parquet(path)
            return [name]
        part, key = PARTITION_COLS[table]
        df.sortWithinPartitions(part, key).write.option("compression", "zstd").partitionBy(part).parquet(path)
        return [f"{name}/{n}" for n in fs_names(self.spark, path) if n.startswith(f"{part}=")]

    def _commit(self, table: str, dirs: list[str], schema: T.StructType, record: LoadResult | None = None,
                batch: str | None = None) -> None:
        """Switch readers to ``dirs``."""
        st = self.state(table)
        version = st["version"] + 1 if st else 1
        # the batches known before this pointer; a batch is looked up there and in the pointer itself
        if st and st.get("batch"):
            fs_create_text(self.spark, f"{self.root}/{table}/_current/batches/{st['batch']}", json.dumps(st["record"]))
        body = {"version": version, "dirs": dirs, "schema": schema.json(), "batch": batch and batch_key(batch),
                "record": record and asdict(record)}
        if not fs_create_text(self.spark, f"{self.root}/{table}/_current/{version:08d}.json", json.dumps(body)):
            raise ConcurrentLoad(f"{table}: version {version} was written by another load")
        release_shuffles(self.spark)

    def loaded(self, table: str, batch: str) -> LoadResult | None:
        """What loading ``batch`` did, if it is in the table."""
        st, key = self.state(table), batch_key(batch)
        if st and st.get("batch") == key:
            return LoadResult(**st["record"])
        folder = f"{self.root}/{table}/_current/batches"
        return LoadResult(**json.loads(fs_read_text(self.spark, f"{folder}/{key}"))) \
            if key in fs_names(self.spark, folder) else None

    def vacuum(self, table: str) -> None:
        """Delete the load folders that the current version does not list (readers of older versions end)."""
        used = {d.split("/")[0] for d in (self.state(table) or {"dirs": []})["dirs"]}
        for n in fs_names(self.spark, f"{self.root}/{table}"):
            if n.startswith("load=") and n not in used:
                fs_drop(self.spark, f"{self.root}/{table}/{n}")

    # ---------------------------------------------------------- SNK-10
    def create(self, schemas: dict[str, T.StructType]) -> None:
        """Create every missing table as an empty first version."""
        for t, schema in schemas.items():
            if not self.exists(t):
                self._commit(t, [], schema)

    def reset(self, tables: list[str] | None = None) -> None:
        """Empty tables: the next version lists no folder and keeps the schema."""
        for t in tables or [t for t in STAR_TABLES if self.exists(t)]:
            self._commit(t, [], T.StructType.fromJson(json.loads(self.state(t)["schema"])))

    # ----------------------------------------------------------- writes
    def write_snapshot(self, table: str, df: DataFrame, record: LoadResult | None = None, batch: str | None = None) -> None:
        """The rows of ``df`` become the table."""
        self._commit(table, self._save(table, df), df.schema, record, batch)

    def insert(self, table: str, rows: DataFrame, record: LoadResult, batch: str | None = None) -> None:
        """Add rows whose keys are known to be new."""
        st = self.state(table)
        schema = T.StructType.fromJson(json.loads(st["schema"]))
        old = st["dirs"]
        if table not in PARTITION_COLS and old:  # a dimension stays one snapshot
            rows = self.read(table).unionByName(rows.select(*schema.names))
            old = []
        self._commit(table, old + self._save(table, rows.select(*schema.names)), schema, record, batch)

    def note(self, table: str, record: LoadResult, batch: str) -> None:
        """Remember a batch without a change of rows."""
        st = self.state(table)
        self._commit(table, st["dirs"], T.StructType.fromJson(json.loads(st["schema"])), record, batch)

    def load(self, table: str, new: DataFrame, spec: TableSpec | None = None, order=None,
             prune_by: str | list[str] | None = None, batch: str | None = None, unique: bool = False) -> LoadResult:
        """SNK-1 / SNK-2 into ``table``.

        For an upsert the batch is reduced to one row per key, met with the table's keys and the
        columns it would replace and written once with what is to be done; counts and rows come
        from there.  Rows that are in the table with equal values are kept, not rewritten: a reload
        without changes writes no data.  For an insert-or-ignore only the keys meet the table's, and
        only rows with new keys are reduced and written: whole rows that are there already stay
        where they are.

        ``prune_by`` names columns the conflict key determines (upload order numbers hash in the
        order date): the table is semi-joined to the batch's distinct values first, so an
        insert-or-ignore reads only the matching slice of a large fact; with the year partition
        column among them, dynamic partition pruning skips whole year directories.  ``unique``: the
        batch is known to hold each key once (a first load then needs no shuffle).
        """
        if batch and (done := self.loaded(table, batch)):
            return done
        spec = spec or TABLE_SPECS[table]
        keys = list(spec.keys)
        if not self.exists(table) or not self.state(table)["dirs"]:
            st = self.state(table)
            cols = T.StructType.fromJson(json.loads(st["schema"])).names if st else \
                TABLE_COLUMNS.get(table, [c for c in new.columns if not c.startswith("_")])
            rows = new.withColumn("_more", F.lit(0).cast("long")) if unique else dedupe_batch(
                new, keys, order, "first" if spec.update_cols is None else "last", count_col="_more")
            dirs = self._save(table, rows.select(*cols, "_more"))
            schema = new.select(*cols).schema
            m = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(
                *[f"{self.root}/{table}/{d}" for d in dirs]).agg(F.count(F.lit(1)).alias("n"), F.sum("_more").alias("more")).first() \
                if dirs else {"n": 0, "more": 0}
            res = LoadResult(table, m["n"] + (m["more"] or 0), m["n"], 0, m["more"] or 0)
            self._commit(table, dirs, schema, res, batch)
            return res
        staging = shared_path(self.spark, "warehouse_staging", f"{table}-{uuid.uuid4().hex}")
        if spec.update_cols is None:
            res = self._insert_new(table, new, keys, order, prune_by, staging, batch)
            fs_drop(self.spark, staging)
            return res
        self._judge(table, new, keys, spec.update_cols, order, prune_by).write.parquet(staging)
        judged = self.spark.read.parquet(staging)
        n = {r["_do"]: (r["n"], r["more"]) for r in judged.groupBy("_do").agg(
            F.count(F.lit(1)).alias("n"), F.sum("_more").alias("more")).collect()}
        get = lambda a: n.get(a, (0, 0))[0]
        more = sum(v[1] for v in n.values())
        res = LoadResult(table, sum(v[0] for v in n.values()) + more, get("insert"), get("update"), more, get("keep"))
        rows = judged.where("_do <> 'keep'").drop("_do", "_more")
        if res.updated:
            self._merge(table, rows, judged, keys, list(spec.update_cols), res, batch)
        elif res.inserted:
            self.insert(table, rows, res, batch)
        elif batch:  # nothing to write; the pointer notes the batch
            self.note(table, res, batch)
        fs_drop(self.spark, staging)
        return res

    def _matchable(self, table, new, keys, prune_by) -> DataFrame:
        """The table's rows that the batch's keys can meet."""
        target = self.read(table)
        if prune_by:
            cols = [prune_by] if isinstance(prune_by, str) else list(prune_by)
            target = target.join(new.select(*cols).distinct(), cols, "left_semi")
        elif table in PARTITION_COLS and PARTITION_COLS[table][1] in keys:
            # the key holds the date: only the years of the batch can match
            target = target.join(new.select(PARTITION_COLS[table][0]).distinct(), PARTITION_COLS[table][0], "left_semi")
        return target

    def _insert_new(self, table, new, keys, order, prune_by, staging, batch) -> LoadResult:
        """Insert the first row of each key that is not in the table."""
        columns = self.read(table).columns
        there = self._matchable(table, new, keys, prune_by).select(*keys)
        new.select(*keys).distinct().join(there, keys, "left_anti").write.parquet(f"{staging}/keys")
        fresh = self.spark.read.parquet(f"{staging}/keys").select(*[F.col(k).alias(f"_new_{k}") for k in keys])
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
        dedupe_batch(new.join(fresh, on, "left_semi"), keys, order, "first").select(*columns).write.parquet(f"{staging}/rows")
        rows = self.spark.read.parquet(f"{staging}/rows")
        read, inserted = new.count(), rows.count()
        res = LoadResult(table, read, inserted, 0, read - inserted)
        if inserted:
            self.insert(table, rows, res, batch)
        elif batch:  # nothing to write; the pointer notes the batch
            self.note(table, res, batch)
        return res

    def _judge(self, table, new, keys, update_cols, order, prune_by) -> DataFrame:
        """The batch's row per key with ``_do`` (insert, update, keep) and ``_more`` (its repeats in the batch);
        of rows that are kept only these two are given, the others are null."""
        rows = dedupe_batch(new, keys, order, "last", count_col="_more")
        rows = rows.select(*self.read(table).columns, "_more")
        old = self._matchable(table, new, keys, prune_by).select(
            *keys, *[F.col(c).alias(f"_old_{c}") for c in update_cols], F.lit(True).alias("_there"))
        same = F.lit(True)
        for c in update_cols:
            same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
        do = F.when(F.col("_there").isNull(), "insert").when(same, "keep").otherwise("update")
        judged = rows.join(old, keys, "left").withColumn("_do", do)
        return judged.select(*[F.when(F.col("_do") != "keep", F.col(c)).alias(c) for c in rows.columns if c != "_more"],
                             "_more", "_do")

    def _merge(self, table, rows, judged, keys, update_cols, res, batch) -> None:
        """Write changed and new rows: a dimension as a new snapshot, of a fact only the years with
        changed rows again (the rest of its new rows are added beside the old folders)."""
        st = self.state(table)
        schema = T.StructType.fromJson(json.loads(st["schema"]))
        target = self.read(table)
        old = []
        if table in PARTITION_COLS:
            part = PARTITION_COLS[table][0]
            years = [r[0] for r in judged.where("_do = 'update'").select(part).distinct().collect()]  # bounded by the calendar
            again = target.where(F.col(part).isin(years))
            out = merge_upsert(again, rows.where(F.col(part).isin(years)), keys, update_cols).select(*schema.names) \
                .unionByName(rows.where(~F.col(part).isin(years)).select(*schema.names))
            old = [d for d in st["dirs"] if d.split(f"{part}=")[-1] not in {str(y) for y in years}]
        else:
            out = merge_upsert(target, rows, keys, update_cols).select(*schema.names)
        self._commit(table, old + self._save(table, out), schema, res, batch)

    # ----------------------------------------------------------- SNK-8
    def audit(self, rows: list[dict]) -> None:
        """The ledger of loads: for a batch that is loaded ``once`` one row per (batch, step, table), where a
        success takes the place of a failure and is never replaced; otherwise one row per load."""
        path = f"{self.root}/etl_audit_log"
        names = [n for n in fs_names(self.spark, path) if n.startswith("entry=")]
        done = {r["entry"]: r for r in self._ledger().where("status = 'success'").select("entry").collect()} if names else {}
        known = len(names)
        recs = []
        for r in rows:
            entry = batch_key(f"{r['batch_id']}|{r['table_name']}", r.get("pipeline_step", "load")) if r.get("once") \
                else uuid.uuid4().hex
            if entry in done:
                continue
            known += f"entry={entry}" not in names
            recs.append((entry, known, r.get("batch_id"), r.get("pipeline_step", "load"), r.get("table_name"),
                         int(r.get("rows_read", 0)), int(r.get("rows_inserted", 0)), int(r.get("rows_updated", 0)),
                         int(r.get("rows_rejected", 0)), r.get("status", "success"), r.get("error_message"),
                         r.get("started_at"), r.get("completed_at"), r.get("duration_seconds")))
        if recs:
            schema = T.StructType([T.StructField("entry", T.StringType()), *AUDIT_SCHEMA.fields])
            self.spark.createDataFrame(recs, schema).coalesce(1).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("entry").parquet(path)

    def _ledger(self) -> DataFrame:
        schema = T.StructType([*AUDIT_SCHEMA.fields, T.StructField("entry", T.StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/etl_audit_log")

    def audit_log(self) -> DataFrame:
        if not [n for n in fs_names(self.spark, f"{self.root}/etl_audit_log") if n.startswith("entry=")]:
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self._ledger().select(*AUDIT_SCHEMA.names)

    # ------------------------------------------------------ UPL-4, UPL-10
    def write_rejects(self, rows: DataFrame, batch_id: str, load: str) -> None:
        """Whole rejected rows (upload, outcome, reason, row, record) by batch, load and reason; a load
        written again under its name replaces its own."""
        fs_drop(self.spark, f"{self.root}/upload_rejects/batch_id={batch_id}/load={load}")
        rows.withColumns({"batch_id": F.lit(batch_id), "load": F.lit(load)}).write.mode("append") \
            .partitionBy("batch_id", "load", "reason").parquet(f"{self.root}/upload_rejects")

    def rejects(self, batch_id: str | None = None, load: str | None = None) -> DataFrame:
        schema = "upload string, outcome string, row long, record string, batch_id string, load string, reason string"
        path = f"{self.root}/upload_rejects"
        df = self.spark.read.schema(schema).parquet(path) if fs_names(self.spark, path) else self.spark.createDataFrame([], schema)
        for c, v in (("batch_id", batch_id), ("load", load)):
            df = df if v is None else df.where(F.col(c) == v)
        return df


def audit_row(params: Params, table: str, res: LoadResult, t0: dt.datetime, t1: dt.datetime,
              status: str = "success", err: str | None = None) -> dict:
    """A ledger row; a batch with a given clock has its time and no duration."""
    if params.batch_clock:
        t0 = t1 = dt.datetime.fromisoformat(params.batch_clock)
    return {"batch_id": params.batch_id, "once": params.once, "pipeline_step": "load", "table_name": table, "rows_read": res.read,
            "rows_inserted": res.inserted, "rows_updated": res.updated, "rows_rejected": res.skipped,
            "status": status, "error_message": err, "started_at": t0, "completed_at": t1,
            "duration_seconds": Decimal(str(round((t1 - t0).total_seconds(), 3)))}


LOAD_ORDER = ["dim_date", "dim_geography", "dim_sales_territory", "dim_therapeutic_class", "dim_drug",
              "dim_customer", "fact_drug_sales", "fact_inventory"]
SUMMARY_SCHEMA = "table string, rows_read long, inserted long, updated long, kept long, skipped long"


def load_all(wh: Warehouse, star: Star, params: Params) -> DataFrame:
    """SNK-7: dimensions first, then facts; one ledger row per table; a load summary.

    With ``params.once`` a replay of the batch loads what its first run left out and nothing twice."""
    results, audit = [], []
    for t in LOAD_ORDER:
        t0 = dt.datetime.now()
        try:
            res = wh.load(t, star[t], batch=params.batch_id if params.once else None, unique=True)
        except Exception as e:  # the failed table is audited with its whole error, then the run fails
            wh.audit([*audit, audit_row(params, t, LoadResult(t, 0, 0, 0, 0), t0, dt.datetime.now(), "failed", str(e))])
            raise
        results.append((t, res.read, res.inserted, res.updated, res.kept, res.skipped))
        audit.append(audit_row(params, t, res, t0, dt.datetime.now()))
    wh.audit(audit)
    return wh.spark.createDataFrame(results, SUMMARY_SCHEMA)
