"""Write the final (post-AQE) physical plan of every job, run at a scale
factor, with the details of its scans to ``docs/plans/<job>.txt``.

    python tools/explain_jobs.py [sf_dir] [out_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from billetic.plans.registry import QUERIES  # noqa: E402
from billetic.session import build_session  # noqa: E402
from billetic.streaming import JOBS  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    os.makedirs(out, exist_ok=True)
    spark = build_session("local[8]", 16, extra={"spark.driver.memory": "4g"})
    for name in JOBS:
        df = QUERIES[name](spark, sf_dir)
        df.collect()                      # run it, so the adaptive plan is final
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        cut = text.find("+- == Initial Plan ==")
        details = text.find("\n\n(1) ")
        scans = [b for b in re.split(r"\n\n+(?=\(\d+\) )", text[details:]) if ") Scan parquet" in b]
        tree = text[:cut] + "\n\n".join(scans) if 0 < cut < details else text
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(f"# {name}: final adaptive plan at {os.path.basename(sf_dir)}\n\n{tree}\n")
    spark.stop()


if __name__ == "__main__":
    main()
