"""Write the formatted physical plan of every registered batch query.

    python tools/explain_all.py [sf_dir] [out_file]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from quarry.plans.registry import QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "/tmp/quarry-plans.txt"
    spark = build_session("local[8]", shuffle_partitions=16)
    with open(out, "w") as fh:
        for name in HEADLINE:
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                QUERIES[name](spark, sf).explain("formatted")
            fh.write(f"===== {name}\n{buf.getvalue()}\n")
    print(out)


if __name__ == "__main__":
    main()
