"""Print the physical plans of the headline queries (condensed ``explain("formatted")``).

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"^(\+-|\s*[:+]|==|\(\d+\) (Scan|Exchange|BroadcastHashJoin|SortMergeJoin|Window|HashAggregate|Generate))"
                  r"|PushedFilters|PartitionFilters|ReadSchema|Arguments: (hashpartitioning|rangepartitioning|SinglePartition)"
                  r"|Left keys|Right keys|Join condition|Keys \[|Functions \[")


def condensed(df) -> str:
    from candlewick.plans.sql import plan_text
    lines = plan_text(df, "formatted").splitlines()
    return "\n".join(line for line in lines if KEEP.search(line))


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from candlewick.operators import analytics as A
    from candlewick.operators.parse import parse_klines
    from candlewick.operators.tables import to_kline_data
    from candlewick.plans.ingest import fixture_warehouse
    from candlewick.session import get_session
    from candlewick.sources.fixtures import fixture_messages
    spark = get_session("local[8]")
    wh = fixture_warehouse(spark, sf_dir)
    kd, ke, sy = wh.table("kline_data"), wh.table("kline_events"), wh.table("symbols")
    shown = {
        "parse (messages -> kline_data)": to_kline_data(parse_klines(fixture_messages(spark, sf_dir))),
        "Q2 avg_volume_by_class": A.avg_volume_by_class(kd, sy),
        "Q3 moving_average, one symbol": A.moving_average(kd, "CLICKUSDT"),
        "Q3 moving_average, all symbols":
            A.moving_average(kd, None, chunk_rows=3000),
        "Q3 moving_average, small chunks": A.moving_average(kd, "CLICKUSDT", chunk_rows=500),
        "Q4 count_between": A.count_between(kd, "2024-01-08", "2024-01-15"),
        "Q5 events_in_candles": A.events_in_candles(ke, kd),
        "Q6 price_delta, small chunks": A.price_delta(kd, "CLICKUSDT", chunk_rows=500),
    }
    for title, df in shown.items():
        print(f"### {title}\n```\n{condensed(df)}\n```\n")


if __name__ == "__main__":
    main(sys.argv)
