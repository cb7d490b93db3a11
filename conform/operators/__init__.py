"""DataFrame-to-DataFrame operators, for use alone or with ``DataFrame.transform``."""

from conform.operators.columns import (
    add_column,
    clean_headers,
    combine_columns,
    flatten_struct,
    hash_and_drop,
    map_arrow,
    map_batches,
    null_column,
    project_like,
    split_to_columns,
)
from conform.operators.joins import equi_join
from conform.operators.protect import new_keys, protect, vault_delta
from conform.operators.schema import (
    cast_checked,
    cast_counts,
    cast_lost_rows,
    column_names,
    column_names_types,
    column_report,
    common_columns,
    control_columns,
    control_pairs,
    difference_columns,
    not_null_columns,
    same_schema,
)
from conform.operators.standardise import (
    rule_conflicts,
    rules_for,
    standardise,
    standardise_any,
    unmatched_values,
)

__all__ = [
    "add_column",
    "cast_checked",
    "cast_counts",
    "cast_lost_rows",
    "clean_headers",
    "column_names",
    "column_names_types",
    "column_report",
    "combine_columns",
    "common_columns",
    "control_columns",
    "control_pairs",
    "difference_columns",
    "equi_join",
    "flatten_struct",
    "hash_and_drop",
    "map_arrow",
    "map_batches",
    "new_keys",
    "not_null_columns",
    "null_column",
    "project_like",
    "protect",
    "rule_conflicts",
    "rules_for",
    "same_schema",
    "split_to_columns",
    "standardise",
    "standardise_any",
    "unmatched_values",
    "vault_delta",
]
