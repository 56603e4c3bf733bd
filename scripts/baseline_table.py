"""Time every registered query (warm-up counts rows, then median of three noop
runs) and print one markdown row per key as it finishes.

usage: python scripts/baseline_table.py [sf_dir] [--skip k1,k2]
"""
import os
import statistics
import subprocess
import sys
import time

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from lotmarket.plans import catalog
from lotmarket.session import local_session


def main():
    args = sys.argv[1:]
    sf_dir = next((a for a in args if a.startswith("/")), "/root/testdata/sf0.1")
    skip = set()
    if "--skip" in args:
        skip = set(args[args.index("--skip") + 1].split(","))
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app_name="lotmarket-baseline")
    commit = subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True,
                            cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__)))).stdout.strip()
    for k, fn in catalog.queries().items():
        if k in skip:
            continue
        rows = fn(spark, sf_dir).count()
        ts = []
        for _ in range(3):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        print(f"| {k} | {statistics.median(ts):.3f} | {rows} | {cpus} | {commit} |", flush=True)


if __name__ == "__main__":
    main()
