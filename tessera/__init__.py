"""tessera: a Spark-native raw → cleaned → star-schema sales analytics library.

Entry points::

    from tessera import PipelineConfig, run_pipeline, bronze_to_silver, silver_to_gold, gold_to_bi
    from tessera import GateFailure, QUERIES, SQL
"""

__version__ = "0.1.0"

from tessera.operators.quality import GateFailure  # noqa: E402
from tessera.plans.catalog import QUERIES, SQL  # noqa: E402
from tessera.plans.jobs import (  # noqa: E402
    PipelineConfig,
    bronze_to_silver,
    gold_to_bi,
    ingest,
    run_pipeline,
    silver_to_gold,
)

__all__ = ["GateFailure", "PipelineConfig", "QUERIES", "SQL", "bronze_to_silver", "gold_to_bi", "ingest",
           "run_pipeline", "silver_to_gold"]
