import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from reviewloom import build_session
from reviewloom.plans.tagging import tag_and_repair
spark = build_session("ship", "local[1]", **{{"spark.ui.enabled": "false"}})
rows = spark.createDataFrame([("a great day", 5.0)], "review_text string, rating double")
print("TAG", tag_and_repair(rows).first()["sentiment"])
"""


def test_workers_get_the_package(tmp_path):
    """The worker's own path does not have the repository: another working folder, no PYTHONPATH."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "TAG positive" in out.stdout, out.stderr[-2000:]


def test_workspace_drops_its_tables(spark):
    from reviewloom import Workspace

    space = Workspace(spark, "test")
    kept = space.write(spark.range(3).toDF("x"), "a")
    assert kept.count() == 3
    space.close()
    assert not os.path.exists(space.root.removeprefix("file:"))


def test_a_written_table_leaves_no_shuffle_files(spark):
    import time

    from pyspark.sql import functions as F

    from reviewloom import Workspace

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in found.mkString("\n").split("\n") if "shuffle_" in x}

    space, before, key = Workspace(spark, "test"), files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    counts = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    table = space.write(counts.join(spark.range(50).toDF("k").hint("shuffle_merge"), "k"))
    until = time.time() + 10  # Spark removes them beside other work
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == 50 and spark.conf.get(key) == was


def test_a_cluster_needs_the_shared_folder():
    import pytest

    from reviewloom.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())
