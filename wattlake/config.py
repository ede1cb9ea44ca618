"""Lake layout and run parameters."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# Write modes understood by the partitioned sinks.
OVERWRITE_PARTITIONS = "overwrite_partitions"  # idempotent re-run of one run_date
APPEND = "append"                              # the original append-every-run behaviour

# Fixed value: codec of every Parquet file that the lake and the warehouse write.
PARQUET_CODEC = "zstd"
# How datasets of the lake and the warehouse are written. Of text
# with ever new values, such as ids, version 2 keeps only what differs from the
# value before.
PARQUET_OPTIONS = {"compression": PARQUET_CODEC, "parquet.writer.version": "v2"}


@dataclass(frozen=True)
class LakeConfig:
    """Where each layer lives and how a run writes.

    ``root`` is a shared filesystem/object-store URI visible to every
    executor.  Layer roots default to sub-folders of it.
    """

    root: str
    run_date: _dt.date | None = None
    write_mode: str = OVERWRITE_PARTITIONS
    # Catalog databases: one per lake layer, two warehouse schemas.
    bronze_db: str = "lake_bronze"
    gold_db: str = "lake_gold"
    dwh_gold_db: str = "gold"
    dwh_analytics_db: str = "analytics"
    # What a landing file holds: "snapshot" - every contract line to date, so
    # each day's bronze partition is complete and only the latest counts;
    # "delta" - new lines only, so all partitions add up.  The incremental
    # intake is always a delta.
    landing_content: str = "snapshot"
    # Bronze -> gold input scope of delta landings: "run_date" reads only the
    # partition of the current run_date (partition pruning); "all" re-reads
    # every partition. A snapshot's latest partition is all of it.
    source_scope: str = "run_date"
    # Warehouse load gate (B8): the load is skipped when disabled.
    warehouse_enabled: bool = True
    # Bounded warehouse CSV export size.
    export_limit: int = 1000
    # Mean price: None = floating avg; an int = exact decimal-sum mean at
    # that scale (order-independent, see functions.exact_avg).
    avg_scale: int | None = None
    # How the bronze splits share one landing parse: "parquet" writes the
    # parsed rows once to the bronze staging folder (a standardised raw copy
    # per run date; lineage cut on shared storage, each split then reads only
    # its columns), "persist" keeps them on executors, "none" re-parses the
    # text for every split.
    landing_staging: str = "parquet"
    # Keep identical provider rows once in the curated provider dataset.
    distinct_providers: bool = False
    # Zone quality: validate landing lines before bronze; lines that fail, or
    # whose id the zone already has, go to the quarantine dataset.
    quarantine: bool = False
    # Buckets of the index of accepted ids: about its bytes / 128 MB.
    index_buckets: int = 16
    # Versions of a day that a write leaves, the new one included; None: all,
    # until ``versions.expire``. With a number, nobody may still read an older
    # version, nor a catalog table that was not registered again since.
    keep_versions: int | None = None
    # Landing intake of the daily run: "batch" reads the landing contract
    # file; "incremental" streams only contract files not seen before (exactly
    # once); "ledger" takes new files, and files written again under their
    # name as restatements. All ingest the risk file.
    intake: str = "batch"
    # View exports: False re-exports each view whole (the original
    # behaviour); True writes only the run's partition of the date-stamped
    # views (sales, purchases) under ``year=/month=/day=`` folders.
    incremental_exports: bool = False
    # Optional per-layer roots (e.g. one bucket per layer); default: sub-
    # folders of ``root``.
    landing_root: str | None = None
    bronze_root: str | None = None
    gold_root: str | None = None
    dwh_root: str | None = None
    exports_root: str | None = None

    @property
    def is_snapshot(self) -> bool:
        """Each day's bronze partition holds all contract lines to date."""
        return self.landing_content == "snapshot" and self.intake == "batch"

    def _layer(self, override: str | None, name: str) -> str:
        return (override or "/".join([self.root.rstrip("/"), name])).rstrip("/")

    @property
    def landing(self) -> str:
        return self._layer(self.landing_root, "landing")

    @property
    def bronze(self) -> str:
        return self._layer(self.bronze_root, "bronze")

    @property
    def gold(self) -> str:
        return self._layer(self.gold_root, "gold")

    @property
    def dwh(self) -> str:
        return self._layer(self.dwh_root, "dwh")

    @property
    def exports(self) -> str:
        return self._layer(self.exports_root, "exports")

    def catalog_location(self, db: str) -> str:
        """Folder of a lake database's own metadata (views); tables are
        external and stay in their layer folders."""
        return self._layer(None, f"_catalog/{db}")

    @property
    def checkpoints(self) -> str:
        return self._layer(None, "_checkpoints")

    @property
    def runs(self) -> str:
        return self._layer(None, "_runs")

    def bronze_path(self, name: str) -> str:
        return f"{self.bronze}/{name}"

    def gold_path(self, name: str) -> str:
        return f"{self.gold}/{name}"
