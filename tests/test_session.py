import pytest

from tallyworks import session
from tests.conftest import plan


def test_tasks_grow_with_the_input():
    assert session.partitions_for(0) == 1
    assert session.partitions_for(10 * session.BYTES_PER_PARTITION) == 10
    assert session.partitions_for(10**14) == session.MAX_PARTITIONS
    assert session.scan_split_for(10**12) == session.SCAN_SPLIT
    assert 10**14 / session.scan_split_for(10**14) <= session.SCAN_TASKS


def test_tune_measures_the_input(spark, monkeypatch):
    partitions = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    split = "spark.sql.files.maxPartitionBytes"
    session.tune(spark, "/root/testdata/sf0.001")
    assert spark.conf.get(partitions, None) is None
    before = spark.conf.get(split)
    session.size_tasks(spark, 10**14)
    assert int(spark.conf.get(partitions)) == session.MAX_PARTITIONS
    assert int(spark.conf.get(split)) == 10**9
    spark.conf.unset(partitions)
    spark.conf.set(split, before)


def test_input_size_is_that_of_the_files(spark):
    import os

    folder = "/root/testdata/sf0.001"
    expected = sum(os.path.getsize(f"{folder}/{name}") for name in os.listdir(folder))
    assert session.input_bytes(spark, folder) == expected


def test_work_paths_are_new_and_under_the_shared_folder(spark):
    one, two = session.work_path(spark, "x"), session.work_path(spark, "x")
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


@pytest.mark.parametrize("keep", [session.cut_lineage, session.keep_table])
def test_kept_results_no_longer_depend_on_their_input(spark, keep):
    kept = keep(spark.range(5).where("id > 1"))
    assert sorted(row[0] for row in kept.collect()) == [2, 3, 4]
    assert "Range" not in plan(kept)
    assert keep(spark.range(0)).dtypes == [("id", "bigint")]


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = type(
            "Context",
            (),
            {"master": "spark://host", "getCheckpointDir": staticmethod(lambda: None)},
        )

    with pytest.raises(RuntimeError):
        session.shared_root(Cluster)
