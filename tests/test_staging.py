from __future__ import annotations

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from scholaudit.sources.staging import NoSharedFolder, staging, staging_root
from scholaudit.sources.tables import create_database, create_or_replace


def _folders(spark):
    return [name for _, names, _ in os.walk(staging_root(spark)) for name in names if name.startswith("clean-up")]


def test_a_run_removes_what_it_staged(spark):
    with staging(spark, "clean-up") as keep:
        assert keep(spark.range(5), "rows").count() == 5
        assert _folders(spark)
    assert not _folders(spark)
    with pytest.raises(ZeroDivisionError), staging(spark, "clean-up") as keep:
        keep(spark.range(5), "rows")
        raise ZeroDivisionError
    assert not _folders(spark)


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_a_cluster_needs_a_shared_folder(master):
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, other=None: other), sparkContext=SimpleNamespace(master=master)
    )
    with pytest.raises(NoSharedFolder):
        staging_root(session)


def test_a_failed_write_leaves_the_old_table(spark):
    create_database(spark, "replacing")
    create_or_replace(spark.range(3), "replacing.one")
    with pytest.raises(Exception, match="broken"):
        create_or_replace(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), "replacing.one")
    assert spark.table("replacing.one").count() == 3
    # The view and its one version.
    assert spark.sql("SHOW TABLES IN replacing").count() == 2
    create_or_replace(spark.range(4), "replacing.one")
    assert spark.table("replacing.one").count() == 4
