"""Shape of every load's physical plan: scans, shuffles, broadcasts, partial
window limits - with lookups broadcast (small) and shuffled (above the bound).

    python scripts/plan_report.py [sf_dir]
"""
from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedspark.plans import landing as L  # noqa: E402
from feedspark.plans import loads  # noqa: E402
from feedspark.plans import registry as R  # noqa: E402
from feedspark.session import local_session  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]  # the tree only


def shape(df) -> dict[str, int]:
    t = plan_text(df)
    return {
        "json scans": len(re.findall(r"Scan json", t)),
        "shuffles": len(re.findall(r"Exchange \(", t)) - len(re.findall(r"BroadcastExchange", t)),
        "broadcasts": len(re.findall(r"BroadcastExchange", t)),
        "sort-merge joins": len(re.findall(r"SortMergeJoin", t)),
        "partial window limits": len(re.findall(r"WindowGroupLimit", t)) // 2,
    }


def rows_plans(spark, sf):
    seeds = L.seed_lookups(spark, sf)
    flat = {f: R.flat_feed(spark, sf, f).select(*loads.NEEDED[f]) for f in L.BUILDERS}
    adv = loads.with_tenant(flat["advertiser"], seeds["tenant"], miss="keep")
    return {
        "client (PL-01)": loads.client_rows(adv),
        "product (PL-02)": loads.product_rows(adv, seeds["client"]),
        "network (PL-03)": loads.network_rows(loads.with_tenant(flat["destination"], seeds["tenant"], miss="keep")),
        "estimate (PL-04)": loads.estimate_rows(loads.with_client(flat["estimate"], seeds["client"], miss="keep")),
        "daypart (PL-05)": loads.daypart_rows(loads.with_client(flat["daypart"], seeds["client"], miss="keep")),
        "program (PL-06)": loads.program_rows(loads.with_network(loads.with_tenant(flat["program"], seeds["tenant"], miss="keep"), seeds["network"])),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our checked broadcasts
    cols = ["json scans", "shuffles", "broadcasts", "sort-merge joins", "partial window limits"]
    print("| rows of | lookups | " + " | ".join(cols) + " |")
    print("|---|---|" + "---|" * len(cols))
    for bound, label in (("1000000", "broadcast (checked)"), ("0", "shuffled")):
        spark.conf.set("feedspark.lookup.broadcastMaxRows", bound)
        for name, df in rows_plans(spark, sf).items():
            s = shape(df)
            print(f"| {name} | {label} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
