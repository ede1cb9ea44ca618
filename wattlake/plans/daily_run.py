"""End-to-end run of the lake for one processing date.

Dependency order: bronze -> catalog -> {views, four gold jobs} -> analytics
-> warehouse -> exports.  The four gold jobs only read bronze and write
separate datasets, so they may be submitted concurrently to the one session
(Spark schedules their stages side by side).

Every step that ends well leaves a record below the run's date: the versions of
the datasets (or the landing files) that it read, and those that it wrote. With
``resume=True`` a step whose record still holds - same inputs, and what it wrote
is still there - is skipped, so a run that failed goes on from the failed step, and
one whose inputs changed redoes what depends on them.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from wattlake.config import LakeConfig
from wattlake.plans import intake, jobs
from wattlake.schemas import BRONZE_SCHEMAS
from wattlake.session import resolve_run_date
from wattlake.sources import versions
from wattlake.sources.incremental import ingest_bronze_incremental
from wattlake.sources.landing import risk_paths

log = logging.getLogger(__name__)

GOLD_JOBS = {
    "transacciones_curated": jobs.curate_transacciones,
    "transacciones_agg": jobs.aggregate_transacciones,
    "proveedores": jobs.curate_proveedores,
    "clientes": jobs.curate_clientes,
}
#: Bronze dataset that each gold job reads.
READS = {"transacciones_curated": "transacciones", "transacciones_agg": "transacciones", "proveedores": "proveedores",
         "clientes": "clientes"}


class _Ledger:
    """Records of one run's steps."""

    def __init__(self, spark: SparkSession, cfg: LakeConfig, run_date: _dt.date):
        self.spark, self.cfg, self.run_date = spark, cfg, run_date

    def _path(self, step: str) -> str:
        return f"{self.cfg.runs}/{self.run_date.isoformat()}/{step}.json"

    def versions(self, *roots: str) -> dict:
        """Current versions, up to the run's date, by dataset."""
        return {r: versions.names({d: v for d, v in versions.current(self.spark, r).items() if d <= self.run_date})
                for r in roots}

    def landing(self) -> list:
        """The landing files, as their listing states them: one entry a file."""
        found = [intake.landing_files(self.spark, self.cfg)]
        files = [[r["file"], r["size"], str(r["modified"])] for df in found for r in df.collect()]
        for path in risk_paths(self.cfg.landing):
            fs, p = versions._fs(self.spark, path)
            if fs.exists(p):
                status = fs.getContentSummary(p)
                files.append([path, status.getLength(), str(fs.getFileStatus(p).getModificationTime())])
        return sorted(files)

    def holds(self, step: str, inputs, outputs) -> dict | None:
        """The step's record, if it still holds."""
        text = versions.read_text(self.spark, self._path(step))
        record = json.loads(text) if text else None
        return record if record and record["inputs"] == inputs and record["outputs"] == outputs else None

    def note(self, step: str, inputs, outputs, result) -> None:
        versions.write_text(self.spark, self._path(step), json.dumps(
            {"inputs": inputs, "outputs": outputs, "result": result}))


def run_all(spark: SparkSession, cfg: LakeConfig, run_date: _dt.date | None = None,
            parallel: bool = True, export: bool = True,
            contratos: DataFrame | None = None, resume: bool = False, retries: int = 0) -> dict:
    """``contratos`` optionally supplies the landing frame instead of the
    landing files (e.g. one derived from other tables); its bronze step is never
    skipped. A step that fails is tried again up to ``retries`` times."""
    run_date = resolve_run_date(spark, run_date or cfg.run_date)
    report: dict = {"run_date": run_date.isoformat(), "seconds": {}, "skipped": []}
    ledger = _Ledger(spark, cfg, run_date)
    bronze = [cfg.bronze_path(n) for n in BRONZE_SCHEMAS]
    gold = [cfg.gold_path(n) for n in jobs.GOLD_DATASETS]

    def step(name, fn, *args, reads=None, writes=(), **kw):
        t0 = time.perf_counter()
        inputs = reads() if reads else None
        record = ledger.holds(name, inputs, ledger.versions(*writes)) if resume and reads else None
        if record is not None:
            report["skipped"].append(name)
            report[name] = record["result"]
            return record["result"]
        for attempt in range(retries + 1):
            try:
                out = fn(*args, **kw)
                break
            except Exception:
                if attempt == retries:
                    raise
                log.warning("step %s failed; trying again", name, exc_info=True)
        if reads:
            ledger.note(name, inputs, ledger.versions(*writes), out)
        report["seconds"][name] = round(time.perf_counter() - t0, 3)
        report[name] = out
        return out

    take_in = {"incremental": ingest_bronze_incremental, "ledger": intake.ingest_bronze_ledger}.get(cfg.intake)
    if take_in is not None and contratos is None:
        step("bronze", take_in, spark, cfg, run_date=run_date, reads=ledger.landing, writes=bronze)
    else:
        step("bronze", jobs.ingest_bronze, spark, cfg, run_date, contratos=contratos,
             reads=ledger.landing if contratos is None else None, writes=bronze)
    # the catalog belongs to the session: registering is cheap and never skipped
    step("registered", jobs.register_layers, spark, cfg, run_date)
    step("views", jobs.create_views, spark, cfg, run_date)

    def gold_step(name):
        return step(name, GOLD_JOBS[name], spark, cfg, run_date,
                    reads=lambda: ledger.versions(cfg.bronze_path(READS[name])), writes=[cfg.gold_path(name)])

    if parallel:
        with ThreadPoolExecutor(max_workers=len(GOLD_JOBS)) as pool:
            report["gold"] = dict(zip(GOLD_JOBS, pool.map(gold_step, GOLD_JOBS)))
    else:
        report["gold"] = {name: gold_step(name) for name in GOLD_JOBS}
    made = lambda: ledger.versions(*gold)
    step("analytics", jobs.energy_totals, spark, cfg, run_date, reads=made)
    step("registered_gold", jobs.register_layers, spark, cfg, run_date)
    step("warehouse", jobs.load_warehouse, spark, cfg, run_date, reads=made)
    if export:
        step("view_exports", jobs.export_views, spark, cfg, run_date=run_date, reads=lambda: ledger.versions(*bronze))
        if report["warehouse"]:
            step("warehouse_exports", jobs.export_warehouse, spark, cfg, run_date, reads=made)
    log.info("run %s done: %s", run_date, report)
    return report
