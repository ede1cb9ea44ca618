"""Command-line job runner, per-layer roots."""

import os

import pytest

from tests.sample_data import write_landing
from wattlake.__main__ import run
from wattlake.config import LakeConfig
from wattlake.sources.lake import read_dataset


def test_layer_roots():
    c = LakeConfig(root="s3a://lake/", gold_root="s3a://gold-bucket")
    assert (c.landing, c.bronze, c.gold) == ("s3a://lake/landing", "s3a://lake/bronze", "s3a://gold-bucket")
    assert c.gold_path("transacciones_agg") == "s3a://gold-bucket/transacciones_agg"


def test_cli_jobs(spark, tmp_root, capsys):
    write_landing(tmp_root)
    env = os.path.basename(tmp_root).replace("-", "_").lower()
    base = ["--root", tmp_root, "--run-date", "2024-06-01", "--env", env,
            "--gold-root", f"{tmp_root}/gold_bucket"]
    assert len(run(["bronze", *base], spark)) == 4
    assert run(["transacciones_agg", *base], spark) is True
    assert read_dataset(spark, f"{tmp_root}/gold_bucket/transacciones_agg").count() == 5
    views = run(["views", *base], spark)
    assert f"lake_bronze_{env}.v_clientes" in views
    assert '"job": "views"' in capsys.readouterr().out


def test_scale_conf():
    from wattlake.session import scale_conf
    big = scale_conf(100 * (1 << 40))                       # 100 TB shuffle
    assert int(big["spark.sql.shuffle.partitions"]) == 819200
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(128 << 20)
    assert scale_conf(10 << 20)["spark.sql.shuffle.partitions"] == "1"
    assert scale_conf(1 << 55)["spark.sql.shuffle.partitions"] == str(1 << 28)   # no cap
    with pytest.raises(ValueError):
        scale_conf(1 << 60)
