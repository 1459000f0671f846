"""DataFrame -> DataFrame operators: specs, typed projections, incremental
new-row detection and dataset routing."""

from .increment import (
    MAX_PRUNE_VALUES,
    anti_join_new,
    hot_keys,
    load_counts,
    new_lake_rows,
    new_warehouse_rows,
    partition_predicate,
    partition_values,
    prune_to_batch,
    prune_to_values,
    stored_keys,
)
from .project import typed_columns, typed_projection
from .routing import BUSINESS_COLUMNS, match_condition, route, with_target_names
from .spec import ColumnSpec, DatasetSpec, dataset_spec, flag_set, specs_from_rows, warehouse_ddl
