"""The shared folder comes from the session."""

import os
import subprocess
import sys

import pytest

from tarmac import session

PLAIN = """
import os, sys
from tarmac.session import local_session, shared_dir
spark = local_session("2", 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
if len(sys.argv) > 2:
    spark.sparkContext.setCheckpointDir(sys.argv[2])
from tarmac.workload import fields, star
rows = star.QUERIES["nearest_segment"][0](spark, sys.argv[1]).count()
print("ROWS", rows, shared_dir(spark))
"""


class FakeContext:
    applicationId = "fake"

    def __init__(self, master, folder=None):
        self.master, self._folder = master, folder

    def getCheckpointDir(self):
        return self._folder


class FakeSession:
    def __init__(self, master, folder=None, **conf):
        self.conf = conf
        self.sparkContext = FakeContext(master, folder)


def test_configured_folder_wins():
    fake = FakeSession("yarn", "hdfs:///other", **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.shared_dir(fake) == "hdfs:///shared"
    assert session.scratch_path(fake, "x").startswith("hdfs:///shared/x-")


def test_folder_of_the_context():
    assert session.shared_dir(FakeSession("yarn", "hdfs:///context")) == "hdfs:///context"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("yarn"))


@pytest.mark.parametrize("given", [False, True])
def test_spark_without_any_settings(tmp_path, given):
    """A fresh process whose Spark has no defaults runs a query that cuts its lineage."""
    (tmp_path / "conf").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": root, "TARMAC_DRIVER_MEMORY": "2g", "TMPDIR": str(tmp_path)}
    folder = [str(tmp_path / "given")] if given else []
    done = subprocess.run(
        [sys.executable, "-c", PLAIN, "/root/testdata/sf0.001", *folder], env=env, capture_output=True, text=True, timeout=300
    )
    assert "ROWS" in done.stdout, done.stderr[-2000:]
    assert str(tmp_path) in done.stdout


def test_lineage_is_cut(spark):
    df = session.cut_lineage(spark.range(10).selectExpr("id * 2 AS v"))
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in df.collect()) == list(range(0, 20, 2))
