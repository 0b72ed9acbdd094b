"""Print the formatted physical plan of registered queries.

    python scripts/explain.py [sf_dir] name [name ...]
"""
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coclick.plans import catalog  # noqa: E402
from coclick.session import local_test_session  # noqa: E402

args = sys.argv[1:]
sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
names = [a for a in args if not a.startswith("/")]
spark = local_test_session(tempfile.mkdtemp(prefix="explain-", dir="/tmp"))
spark.sparkContext.setLogLevel("ERROR")
for n in names:
    print(f"==================== {n}")
    catalog.QUERIES[n](spark, sf).explain("formatted")
