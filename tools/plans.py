"""Write PLANS.md: the physical plan tree, scans (pushed filters, read schema) and exchange
count of every registered query, as Spark plans it on the given data set.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from slotwise.plans import registry  # noqa: E402
from slotwise.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans", "",
           f"Initial AQE plans (`explain('formatted')`) of every registered query on `{sf}`; AQE may",
           "still turn small shuffle joins into broadcasts at run time.  Scan paths are shortened.", ""]
    for name, fn in registry.queries().items():
        if name.endswith("_incremental"):
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf).explain("formatted")
        txt = buf.getvalue()
        tree = [ln for ln in txt.split("\n\n")[0].splitlines()[1:] if ln.strip()]
        scans = []
        for blk in txt.split("\n\n"):
            lines = blk.strip().splitlines()
            if lines and "Scan parquet" in lines[0]:
                loc = next((ln for ln in lines if ln.startswith("Location")), "")
                table = re.sub(r".*/", "", loc.rstrip("]"))
                pf = next((ln for ln in lines if ln.startswith("PushedFilters")), "PushedFilters: []")
                part = next((ln for ln in lines if ln.startswith("PartitionFilters")), "")
                rs = next((ln for ln in lines if ln.startswith("ReadSchema")), "")
                scans.append(f"- `{table}` — {part + ' — ' if part else ''}{pf} — {rs}")
        n_ex = sum("Exchange" in ln and "Broadcast" not in ln and "Reused" not in ln for ln in tree)
        out += [f"## {name}", "", f"shuffle exchanges: {n_ex}", "", "```", *tree, "```", "", *scans, ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
