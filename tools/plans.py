"""Write PLANS.md: the physical plan tree of each headline query (sf0.01).

Usage: python tools/plans.py [sf_dir]
"""

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from bitext.plans.registry import QUERIES  # noqa: E402
from bitext.session import build_session  # noqa: E402


def tree_and_scans(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    scans = [blk for blk in details.split("\n\n") if "Scan parquet" in blk.split("\n")[0]]
    keep = []
    for blk in scans[:2]:
        keep.append("\n".join(ln for ln in blk.splitlines()
                              if ln.startswith(("(", "Output", "PushedFilters", "ReadSchema"))))
    return tree.strip() + "\n\n" + "\n\n".join(keep)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    parts = ["# Physical plans of the headline queries\n",
             f"Generated by `tools/plans.py` on `{sf}` (initial adaptive plans; AQE may coalesce "
             "partitions or switch joins to broadcast at runtime).\n"]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        parts.append(f"## {name}\n\n```\n{tree_and_scans(df)}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main()
