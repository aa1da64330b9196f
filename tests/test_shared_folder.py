"""Where intermediate tables go under masters and settings other than those of the tests' session."""

from types import SimpleNamespace

import pytest

import corpus_pipeline
from meterlane import session
from meterlane.llm import queries as llm
from meterlane.plans import catalog
from meterlane.session import materialize, new_path, shared_root

catalog.load_all()


@pytest.fixture()
def cluster(spark, monkeypatch):
    """The tests' session under the master of a cluster, with the given checkpoint folder."""
    conf = spark._jsparkSession.sessionState().conf()
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_tried", set(), raising=False)

    def under(folder=None):
        conf.unsetConf("spark.checkpoint.dir")
        if folder:
            conf.setConfString("spark.checkpoint.dir", folder)
        return spark

    before = spark.conf.get("spark.checkpoint.dir", None)
    yield under
    under(before)


def test_a_path_without_scheme_lies_on_the_default_file_system(cluster, tmp_path):
    spark = cluster(f"{tmp_path}/")
    assert shared_root(spark) == str(tmp_path)
    assert new_path(spark, "x").startswith(f"file://{tmp_path}/x-")
    assert materialize(spark.range(7), "x").count() == 7


def test_paths_of_one_slash_get_a_scheme_that_every_reader_knows(cluster, tmp_path):
    spark = cluster(f"file:{tmp_path}")
    assert new_path(spark, "x").startswith(f"file://{tmp_path}/x-")


def test_a_named_file_system_is_taken_as_it_is(cluster):
    spark = cluster("hdfs://host/folder")
    assert new_path(spark, "x").startswith("hdfs://host/folder/x-")


def test_the_context_s_folder_is_used_without_the_setting(cluster, tmp_path, monkeypatch):
    spark = cluster()
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: f"file:{tmp_path}/own")
    assert new_path(spark, "x").startswith(f"file://{tmp_path}/own/x-")


def test_the_warehouse_is_the_last_resort(cluster, monkeypatch):
    spark = cluster()
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    assert shared_root(spark) == spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/meterlane"


@pytest.mark.parametrize("master, one", [("local", True), ("local[8]", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_only_local_mode_runs_in_one_process(master, one):
    assert session._one_process(SimpleNamespace(sparkContext=SimpleNamespace(master=master))) is one


def test_a_folder_that_the_driver_does_not_see_is_refused(cluster, tmp_path, monkeypatch):
    spark = cluster(str(tmp_path))
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    unseen = SimpleNamespace(range=lambda *_: SimpleNamespace(write=SimpleNamespace(parquet=lambda path: None)),
                             read=SimpleNamespace(schema=lambda s: SimpleNamespace(
                                 parquet=lambda path: spark.read.schema(s).parquet(f"{tmp_path}/empty"))),
                             sparkContext=spark.sparkContext)
    with pytest.raises(RuntimeError, match="another folder on each machine"):
        session._try(unseen, f"file://{tmp_path}")


@pytest.mark.parametrize("name", [
    "backfill_missing_months", "bucketed_join", "create_if_absent", "coalesce_write", "csv_extra_columns",
    "csv_gz_scan", "csv_string_scan", "csv_infer_scan", "csv_to_parquet", "ctas", "dashboard_top_zones",
    "daily_partition_prune", "csv_typed_scan", "dashboard_every_n", "dashboard_totals", "dashboard_vendor",
    "delete_where", "evolve_columns", "duration_p90", "external_vs_native_counts", "full_refresh",
    "filename_lineage", "incremental_cursor", "json_scan_avg", "paged_source"])
def test_queries_run_on_a_cluster_with_a_plain_path(cluster, tmp_path, name):
    spark = cluster(str(tmp_path))
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


@pytest.mark.parametrize("name", sorted(name for name in llm.QUERIES if not name.startswith(("op2_", "op10_"))))
def test_operators_run_on_a_cluster_with_a_plain_path(cluster, tmp_path, name):
    spark = cluster(str(tmp_path))
    llm.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert any(tmp_path.iterdir())


def test_the_pipeline_runs_on_a_cluster_with_a_plain_path(cluster, tmp_path):
    spark = cluster(str(tmp_path))
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
