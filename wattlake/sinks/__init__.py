"""Writers: partitioned Parquet datasets, text exports, warehouse tables."""

from wattlake.sinks.parquet import write_dataset, write_partitioned
from wattlake.sinks.text import export_bounded_csv, export_text

__all__ = ["write_dataset", "write_partitioned", "export_bounded_csv", "export_text"]
