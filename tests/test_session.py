"""Settings and intermediate rows of runs."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from reqmart.session import SETTINGS, checkpoint_root, materialise, run


def folder_of(df) -> str:
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_a_run_leaves_settings_and_folders_as_they_were(spark, setting):
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    setting(**{name.replace(".", "__"): "1m"})
    outside = materialise(spark.range(3))
    with pytest.raises(RuntimeError), run(spark):
        assert spark.conf.get(name) == SETTINGS[name]
        inside = folder_of(materialise(spark.range(5)))
        assert os.path.isdir(inside)
        raise RuntimeError
    assert spark.conf.get(name) == "1m"
    assert not os.path.exists(inside) and outside.count() == 3


@pytest.mark.parametrize("master, warehouse, ok", [
    ("local[4]", "/tmp/warehouse", True), ("spark://host:7077", "/tmp/warehouse", False), ("yarn", "file:/tmp/warehouse", False),
    ("yarn", "hdfs://store/warehouse", True), ("local-cluster[2,1,1024]", "/tmp/warehouse", False),
])
def test_no_folder_of_one_machine_on_a_cluster(master, warehouse, ok):
    conf = {"spark.sql.warehouse.dir": warehouse}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: conf.get(name, default)),
        sparkContext=SimpleNamespace(master=master),
    )
    if ok:
        assert checkpoint_root(session) == f"{warehouse}/_checkpoints"
    else:
        with pytest.raises(ValueError):
            checkpoint_root(session)


def test_scratch_folders_lie_below_the_application_and_go_with_it(spark, tmp_path):
    from reqmart import session

    path = session.scratch_folder(spark)
    of_application = os.path.dirname(path)
    assert of_application in session._removed_at_exit and of_application.endswith(spark.sparkContext.applicationId)
    folder = f"file:{tmp_path}/gone"
    spark.range(3).write.parquet(folder)
    session._remove_at_exit(spark, folder)
    assert not os.path.exists(tmp_path / "gone")


def test_folders_without_a_scheme_are_of_the_default_file_system(spark, tmp_path):
    from reqmart.session import qualified

    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert qualified(spark, f"file://{tmp_path}").startswith("file:/")
