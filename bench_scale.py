"""Time the inversion on copies of the orders table, with and without a hot employee.

Prints one JSON line per trial, the better of two runs after a first one that also
compiles the plan. "collect_list" is the plain grouping of pairs into
lists, for comparison: it takes a group whole into one task.

    python bench_scale.py [copies] [hot share in percent]
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession, functions as F

from memberfold.operators.invert import employee_categories
from memberfold.session import shared_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
CATEGORIES = [5, 16, 32, 64]


def write_pairs(spark, folder, copies, hot_percent):
    """Every copy has employees of its own, but for those moved to the hot one."""
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey", "o_custkey")
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    rows = orders.repartition(int(CPUS) * 2).withColumn("copy", copy)
    mixed = F.xxhash64("o_orderkey", "copy")
    employee = F.concat_ws("-", "o_custkey", "copy")
    rows.select(
        F.when(F.pmod(mixed, F.lit(100)) < hot_percent, "hot").otherwise(employee).alias("empId"),
        *[
            F.format_string("c%03d", F.pmod(F.shiftright(mixed, 8), F.lit(n))).alias(f"of_{n}")
            for n in CATEGORIES
        ],
    ).write.parquet(folder)


def seconds(frame):
    start = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 2)


def main():
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    hot_percent = int(sys.argv[2]) if len(sys.argv) > 2 else 33
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(int(CPUS) * 4))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = shared_folder(spark, "bench")
    for hot in sorted({0, hot_percent}):
        folder = f"{root}/hot-{hot}"
        write_pairs(spark, folder, copies, hot)
        for n in CATEGORIES:
            pairs = spark.read.parquet(folder).select("empId", F.col(f"of_{n}").alias("categoryId"))
            info = F.sort_array(F.collect_list(F.struct("categoryId")))
            trials = {
                "collect_list": pairs.groupBy("empId").agg(info.alias("categoryInfoList")),
                "inversion": employee_categories(pairs, [f"c{i:03d}" for i in range(n)]),
            }
            for name, frame in trials.items():
                _, *warm = [seconds(frame) for _ in range(3)]
                trial = {"plan": name, "categories": n, "hot_percent": hot, "sec": min(warm)}
                print(json.dumps(trial), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
