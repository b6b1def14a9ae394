"""Launcher for spark-submit (which takes a file, not a module):

    spark-submit --py-files portolan.zip tools/run_job.py --arrivals ... --out ...

Arguments are those of ``python -m portolan.plans.job``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from portolan.plans.job import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
