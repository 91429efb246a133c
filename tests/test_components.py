"""Components of graphs with hubs: right roots, and no task that reads a hub's edges."""

import glob
import json
import os
import random
import subprocess
import sys

import pytest

from litmill.operators.components import components
from litmill.sources.scratch import Scratch

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

STAR = """
import sys
from pyspark.sql import SparkSession
from litmill.operators.components import components
from litmill.sources.scratch import Scratch

folder = sys.argv[1]
spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "16").config("spark.ui.enabled", "false")
    .config("spark.sql.adaptive.coalescePartitions.enabled", "false").config("spark.checkpoint.dir", f"file://{folder}/shared")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1").config("spark.eventLog.enabled", "true").config("spark.eventLog.rolling.enabled", "false")
    .config("spark.eventLog.compress", "false").config("spark.eventLog.dir", f"file://{folder}/log").getOrCreate()
)
star = spark.range(1, 1_000_001).selectExpr("500000 AS a", "id AS b").unionAll(spark.range(2_000_000, 2_000_100).selectExpr("id AS a", "id + 1 AS b"))
out = components(star, Scratch(spark, "t")).groupBy("root").count().collect()
assert sorted(map(tuple, out)) == [(1, 1_000_000), (2_000_000, 101)], out
spark.stop()
"""


def brute(edges):
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("hub_edges", [1, 3, 50_000])
def test_roots_with_and_without_hubs(spark, hub_edges):
    rng = random.Random(8)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200, i) for i in range(201, 260)] + [(i, i + 1) for i in range(300, 340)]
    edges += [(b, a) for a, b in edges[:30]] + edges[:10]
    edges = [e for e in edges if e[0] != e[1]]
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), hub_edges).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == brute(edges)


def test_a_star_of_a_million_edges_has_no_large_task(tmp_path):
    os.makedirs(tmp_path / "log")
    run = subprocess.run([sys.executable, "-c", STAR, str(tmp_path)], env=os.environ | {"PYTHONPATH": ROOT, "TMPDIR": str(tmp_path)}, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    stages = {}
    for path in glob.glob(f"{tmp_path}/log/*"):
        for line in open(path):
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                stages.setdefault(event["Stage ID"], []).append(read)
    large = {k: v for k, v in stages.items() if sum(v) > 200_000}
    assert large
    for reads in large.values():  # 16 partitions each
        assert max(reads) < 2 * sum(reads) / len(reads), (max(reads), sum(reads), len(reads))
