"""Where work tables lie when the session runs on a cluster."""

import pytest

from tillflow.llm.common import filesystem
from tillflow.session import new_folder, shared_dir, stored


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077"])
def test_path_without_scheme_on_a_cluster(spark, monkeypatch, master):
    """It is taken in the default file system, where Spark puts its own checkpoints."""
    named = spark.conf.get("spark.checkpoint.dir")
    assert ":" not in named
    monkeypatch.setattr(spark.sparkContext, "master", master)
    assert shared_dir(spark) == f"file:{named}"
    assert filesystem(new_folder(spark, "x"))[1].startswith(f"{named}/tillflow-")
    kept = stored(spark.range(10), "numbers")
    assert kept.count() == 10
    assert kept.inputFiles()[0].replace("file://", "file:").startswith(f"file:{named}/tillflow-")
