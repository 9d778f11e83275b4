"""Write PLANS.md: physical-plan facts of the headline queries on a written star.

usage: python tools/plans.py [sf_dir]
Records, per query: exchanges, join strategies, codegen stages, and for every
scan the pushed filters, partition filters and read schema (from
``explain("formatted")`` after the plan is executed once, so AQE decisions show).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medistar.params import Params  # noqa: E402
from medistar.plans import monitor as M  # noqa: E402
from medistar.plans import quality as DQ  # noqa: E402
from medistar.plans import queries as Q  # noqa: E402
from medistar.plans.star import build_star_to  # noqa: E402
from medistar.session import get_spark, shared_path  # noqa: E402
from medistar.sources import adapter  # noqa: E402


def facts(df) -> dict:
    df.collect() if df.columns else None
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    s = buf.getvalue()
    tree = s.split("\n\n")[0].split("== Initial Plan ==")[0]
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)\s*(\w*)", tree)
    scans = []
    for blk in re.findall(r"\(\d+\) Scan parquet.*?(?=\n\(\d+\) |\Z)", s, flags=re.S):
        loc = re.search(r"Location: \w+ \[(.*?)\]", blk)
        get = lambda k: (re.search(rf"{k}: (.*)", blk).group(1) if re.search(rf"{k}: (.*)", blk) else "")  # noqa
        scans.append({"table": os.path.basename(loc.group(1)) if loc else "?", "pushed": get("PushedFilters"),
                      "partition": get("PartitionFilters"), "schema": get("ReadSchema")})
    return {"exchanges": len(re.findall(r"Exchange", tree)) - len(re.findall(r"BroadcastExchange", tree)),
            "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
            "joins": [f"{a} {b}".strip() for a, b in joins], "scans": scans,
            "final": "AdaptiveSparkPlan isFinalPlan=true" in s}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark(shuffle_partitions=16)
    wh = shared_path(spark, "plans_star", uuid.uuid4().hex)
    star = build_star_to(spark, adapter.load_driver_raw(spark, sf), wh, Params())
    last = Q.preset_range("Last Year", Params().as_of_date)
    cases = {**{k: f(star) for k, f in Q.TIMED.items()},
             "sales_mart": Q.sales_mart(star),
             "kpi_summary (Last Year)": Q.kpi_summary(star, *last),
             "sales_search (2022, AW_INTERNET)": Q.sales_search(star, years=[2022], source_system="AW_INTERNET",
                                                                  min_rev=1000, max_rev=50000),
             "class_share": Q.class_share(star),
             "dq_checks": DQ.dq_checks(star),
             "critical_drugs": M.critical_drugs(star)}
    out = ["# Physical plans (generated by tools/plans.py)", "",
           f"Star written from `{sf}`; plans after one execution (AQE final plans). "
           "Exchanges count shuffle exchanges only.", ""]
    for name, df in cases.items():
        f = facts(df)
        out.append(f"## {name}")
        out.append(f"- shuffle exchanges: {f['exchanges']}, broadcast exchanges: {f['broadcasts']}, "
                   f"joins: {', '.join(f['joins']) or 'none'}")
        for sc in f["scans"]:
            out.append(f"- scan `{sc['table']}`: ReadSchema `{sc['schema']}`")
            if sc["partition"] and sc["partition"] != "[]":
                out.append(f"  - PartitionFilters `{sc['partition']}`")
            if sc["pushed"] and sc["pushed"] != "[]":
                out.append(f"  - PushedFilters `{sc['pushed']}`")
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
