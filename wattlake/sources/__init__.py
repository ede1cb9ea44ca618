"""Readers: landing text, lake datasets, catalog tables, incremental intake."""

from wattlake.sources.landing import read_first_existing, read_landing_csv
from wattlake.sources.lake import read_dataset, read_partition

__all__ = ["read_first_existing", "read_landing_csv", "read_dataset", "read_partition"]
