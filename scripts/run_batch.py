"""spark-submit entry point for the batch job.

    zip -r clickpath.zip clickpath
    spark-submit --py-files clickpath.zip \
        --conf spark.checkpoint.dir=hdfs:///shared/checkpoints \
        scripts/run_batch.py --actions ACTIONS --users USERS --out OUT [options of python -m clickpath]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickpath.__main__ import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
