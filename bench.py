"""Wall time of the registered queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_REPEATS`` (default 2; the fastest run counts) and ``BENCH_QUERIES`` (comma
separated, default all) choose what runs.  Every query runs in full into the
``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerloom import build_session
from ledgerloom.workload.queries import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "ledgerloom-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in chosen:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            try:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as error:  # one failing query must not hide the others
                print(f"{name}: {error}", file=sys.stderr)
                runs = []
                break
            runs.append(time.perf_counter() - start)
        if runs:
            seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": f"total wall time of {len(seconds)} queries, fastest of {repeats} runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
