"""Queries on a cluster whose shared folder is a mounted one: a plain path, or ``file:``."""

import datetime as dt
import os
import random

import duckdb
import pytest

from check import compare
from lapframe import session


@pytest.fixture(params=["", "file://"])
def mounted(request, spark, tmp_path, monkeypatch):
    """The session as on a standalone cluster with its shared tables in a mounted folder."""
    session.shared_dir(spark)
    folder, conf = f"{request.param}{tmp_path}/shared", type(spark.conf)
    plain = conf.get
    monkeypatch.setattr(conf, "get", lambda self, key, *default: folder if key == "spark.checkpoint.dir" else plain(self, key, *default))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    return tmp_path / "shared"


@pytest.fixture
def tables(spark, tmp_path):
    """A few laps of three races, and two tracks."""
    r = random.Random(3)
    laps = [
        (k // 4, k % 4 + 1, k % 9, k % 5, float(k % 50 + 1), 40_000.0 + 900 * (k % 97) + k, k % 11 / 100, k % 9 / 100, "ANR"[k % 3], "FO"[k % 2], dt.datetime(1998 + k % 3, 1 + k % 2, 3))
        for k in range(240)
    ]
    spark.createDataFrame(
        laps,
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    tracks = [(k, [r.uniform(-1, 1) for _ in range(64)]) for k in range(2)]
    spark.createDataFrame(tracks, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def test_a_mounted_folder_is_asked_once(spark, mounted):
    path = session.new_path(spark, "x")
    assert str(mounted) in path
    assert not os.listdir(mounted)
    assert session.materialize(spark.range(9), "t").count() == 9
    assert [f.split("-")[0] for f in os.listdir(mounted)] == ["t"]


def test_a_folder_that_tasks_do_not_share_is_refused(spark, tmp_path):
    class Unshared:
        """Tasks write to another disk: the driver's folder stays empty."""

        conf = {"spark.checkpoint.dir": f"file://{tmp_path}"}
        read = spark.read
        sparkContext = type("Context", (), {n: getattr(spark.sparkContext, n) for n in ("_jvm", "_jsc", "applicationId", "defaultParallelism")} | {"master": "spark://driver:7077"})
        write = property(lambda self: self)

        def range(self, *_):
            return self

        def parquet(self, path):
            os.makedirs(path.removeprefix("file://"))

    with pytest.raises(RuntimeError, match="one machine"):
        session.shared_dir(Unshared())
    assert not os.listdir(tmp_path)


@pytest.mark.parametrize("name", ["baseline_lookup", "baseline_predictions", "boosted_tree_splits", "corner_elev_change", "corner_radius", "corner_spacing", "corner_speeds"])
def test_query_on_a_cluster(spark, mounted, tables, name):
    con = duckdb.connect()
    for table in ("lineitem", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tables}/{table}.parquet/*.parquet')")
    assert compare(spark, con, name, tables) == ""
    assert os.listdir(mounted)
