"""spark-submit launcher for ``tallow.plans.run`` (hourly run or gap backfill).

    spark-submit --py-files tallow.zip scripts/run_hour.py --root s3a://bucket/candles --hour 2025-12-01-05:00
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallow.plans.run import main  # noqa: E402

if __name__ == "__main__":
    main()
