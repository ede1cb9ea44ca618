"""Command line: run one lake job (or the whole run) for a processing date.

    spark-submit --py-files wattlake.zip -m wattlake bronze --root s3a://lake
    python -m wattlake all --root /data/lake --run-date 2024-06-01

Jobs: bronze, incremental_bronze, register, views, transacciones_curated,
transacciones_agg, proveedores_curated, clientes_curated, analytics,
export_views, warehouse, export_warehouse, all.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from wattlake.config import APPEND, OVERWRITE_PARTITIONS, LakeConfig


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wattlake", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job")
    p.add_argument("--root", required=True, help="shared lake root (URI)")
    for layer in ("landing", "bronze", "gold", "dwh", "exports"):
        p.add_argument(f"--{layer}-root", default=None, help=f"override of the {layer} layer root")
    p.add_argument("--run-date", type=_dt.date.fromisoformat, default=None)
    p.add_argument("--env", default=None, help="suffix for catalog database names")
    p.add_argument("--write-mode", choices=[OVERWRITE_PARTITIONS, APPEND], default=OVERWRITE_PARTITIONS)
    p.add_argument("--source-scope", choices=["run_date", "all"], default="run_date")
    p.add_argument("--landing-content", choices=["snapshot", "delta"], default="snapshot")
    p.add_argument("--landing-staging", choices=["parquet", "persist", "none"], default="parquet")
    p.add_argument("--avg-scale", type=int, default=None)
    p.add_argument("--distinct-providers", action="store_true")
    p.add_argument("--intake", choices=["batch", "incremental"], default="batch")
    p.add_argument("--incremental-exports", action="store_true")
    p.add_argument("--no-warehouse", action="store_true", help="skip the warehouse load")
    p.add_argument("--reload", action="store_true", help="warehouse: replace tables with all gold")
    p.add_argument("--largest-shuffle-gb", type=float, default=None,
                   help="size shuffle partitions and scan splits for this much shuffled data")
    return p


def config_from_args(a: argparse.Namespace) -> LakeConfig:
    sfx = f"_{a.env}" if a.env else ""
    return LakeConfig(
        root=a.root, run_date=a.run_date, write_mode=a.write_mode, source_scope=a.source_scope,
        landing_staging=a.landing_staging, landing_content=a.landing_content, avg_scale=a.avg_scale,
        distinct_providers=a.distinct_providers, warehouse_enabled=not a.no_warehouse,
        intake=a.intake, incremental_exports=a.incremental_exports,
        bronze_db=f"lake_bronze{sfx}", gold_db=f"lake_gold{sfx}",
        dwh_gold_db=f"gold{sfx}", dwh_analytics_db=f"analytics{sfx}",
        landing_root=a.landing_root, bronze_root=a.bronze_root, gold_root=a.gold_root,
        dwh_root=a.dwh_root, exports_root=a.exports_root)


JOBS = ["bronze", "incremental_bronze", "register", "views", "transacciones_curated",
        "transacciones_agg", "proveedores_curated", "clientes_curated", "analytics",
        "export_views", "warehouse", "export_warehouse", "all"]


def run(argv: list[str] | None = None, spark=None):
    a = _parser().parse_args(argv)
    if a.job not in JOBS:
        raise SystemExit(f"unknown job {a.job!r}; one of {JOBS}")
    from wattlake.plans import daily_run, jobs
    from wattlake.session import apply_conf, build_session, resolve_run_date, scale_conf
    from wattlake.sources.incremental import ingest_bronze_incremental

    spark = spark or build_session(app_name=f"wattlake-{a.job}")
    if a.largest_shuffle_gb:
        apply_conf(spark, scale_conf(int(a.largest_shuffle_gb * (1 << 30))))
    cfg = config_from_args(a)
    rd = resolve_run_date(spark, cfg.run_date)
    table = {
        "bronze": lambda: jobs.ingest_bronze(spark, cfg, rd),
        "incremental_bronze": lambda: ingest_bronze_incremental(spark, cfg, run_date=rd),
        "register": lambda: jobs.register_layers(spark, cfg),
        "views": lambda: (jobs.register_layers(spark, cfg), jobs.create_views(spark, cfg, rd))[1],
        "transacciones_curated": lambda: jobs.curate_transacciones(spark, cfg, rd),
        "transacciones_agg": lambda: jobs.aggregate_transacciones(spark, cfg, rd),
        "proveedores_curated": lambda: jobs.curate_proveedores(spark, cfg, rd),
        "clientes_curated": lambda: jobs.curate_clientes(spark, cfg, rd),
        "analytics": lambda: jobs.energy_totals(spark, cfg, rd),
        "export_views": lambda: jobs.export_views(spark, cfg, run_date=rd),
        "warehouse": lambda: jobs.load_warehouse(spark, cfg, rd, reload=a.reload),
        "export_warehouse": lambda: jobs.export_warehouse(spark, cfg, rd),
        "all": lambda: daily_run.run_all(spark, cfg, rd),
    }
    assert set(table) == set(JOBS)
    result = table[a.job]()
    print(json.dumps({"job": a.job, "run_date": rd.isoformat(), "result": result}, default=str))
    return result


def main() -> None:
    run(sys.argv[1:])


if __name__ == "__main__":
    main()
