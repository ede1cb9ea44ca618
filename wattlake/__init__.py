"""wattlake: a Spark-native layered lakehouse for energy-trading contract data.

Layers: landing (delimited text) -> bronze (typed, split datasets) -> gold
(curated copies and aggregates) -> warehouse tables, logical views and text
exports.  Every transform is a pure ``DataFrame -> DataFrame`` function; only
``sources``, ``sinks`` and ``plans`` touch storage or the catalog.

Entry points::

    from wattlake import LakeConfig, build_session, run_all
    spark = build_session()
    run_all(spark, LakeConfig(root="s3a://lake"))
"""

from wattlake.config import APPEND, OVERWRITE_PARTITIONS, LakeConfig

__version__ = "0.1.0"
__all__ = ["APPEND", "OVERWRITE_PARTITIONS", "LakeConfig", "build_session", "run_all", "queries"]


def __getattr__(name):
    # Lazy: importing the package does not import PySpark-heavy modules.
    if name == "build_session":
        from wattlake.session import build_session
        return build_session
    if name == "run_all":
        from wattlake.plans.daily_run import run_all
        return run_all
    if name == "queries":
        from wattlake.plans.registry import QUERIES
        return QUERIES
    raise AttributeError(name)
