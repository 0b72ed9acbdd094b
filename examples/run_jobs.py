"""Run the persisted jobs end to end on one test scale (no CLI needed).

    python examples/run_jobs.py /root/testdata/sf0.01 /tmp/some-new-folder

Writes daily layers, merged snapshots, scores, lists, training rows and user
lists under the given base folder, the way the reference's daily actions do.
"""

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from coclick.plans import jobs  # noqa: E402
from coclick.session import build_session  # noqa: E402
from coclick.sources import testdata as T  # noqa: E402


def main(sf: str, base: str, last_day: str = "2024-01-30", days: int = 30) -> None:
    spark = build_session(master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    clicks = T.event_clicks(spark, sf)
    lenient = T.event_clicks(spark, sf, event_type=None, strict_ids=False)
    wl = T.part_whitelist(spark, sf)
    end = dt.date.fromisoformat(last_day)
    for i in range(days - 1, -1, -1):
        d = (end - dt.timedelta(days=i)).isoformat()
        on_day = F.col("day") == F.lit(d).cast("date")
        jobs.itemcf_gen_day(spark, clicks.where(on_day), base, "ID", d)
        jobs.swing_gen_day(spark, lenient.where(on_day), base, "ID", d)
        jobs.graph_gen_day(spark, lenient.where(on_day), base + "/graph", "ID", d, ["user", "day"], "eid")
    jobs.itemcf_merge(spark, base, "ID", last_day, days, wl)
    print("item-CF lists:", jobs.itemcf_join_group(spark, base, "ID"))
    jobs.swing_merge(spark, base, "ID", last_day, days, wl)
    print("Swing scores:", jobs.swing_join(spark, base, "ID", wl, T.part_shops(spark, sf)))
    jobs.swing_group(spark, base, "ID", T.part_features(spark, sf)).show()
    jobs.graph_merge(spark, base + "/graph", "ID", last_day, days, wl)
    print("training rows:", jobs.graph_train_rows(spark, base + "/graph", "ID", last_day, base + "/csv", edge_thre=1))
    print("user lists:", jobs.usercf_lists(spark, clicks.where(F.col("day") < F.lit(last_day).cast("date")),
                                           base, "ID", wl))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
