"""Vector tables, similarity search and partitioned tables on Spark."""

import sys

from pyspark import cloudpickle

from nearspan.functions.filters import FilterGroup, MetaFilter
from nearspan.operators.knn import nearest_join, nearest_to
from nearspan.operators.mmr import nearest_diverse
from nearspan.operators.partition import PartitionSpec, create_partitioned_table
from nearspan.plans.store import VectorStore
from nearspan.schema import MetaColumn, TableConfig
from nearspan.sources.catalog import run_sql

# The helpers that run inside tasks travel with them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "FilterGroup",
    "MetaColumn",
    "MetaFilter",
    "PartitionSpec",
    "TableConfig",
    "VectorStore",
    "create_partitioned_table",
    "nearest_diverse",
    "nearest_join",
    "nearest_to",
    "run_sql",
]
