"""A transaction star-schema engine on PySpark."""

from txnstar.operators.audit import null_dates, row_counts
from txnstar.operators.clean import (
    calendar_parts,
    cast_numbers,
    clean_transactions,
    drop_exact_duplicates,
    drop_unparsed,
    flag_suspicious,
    parse_mixed_timestamps,
    require_columns,
    standard_transactions,
)
from txnstar.operators.keys import (
    assign_key,
    assign_key_in_ranges,
    hot_keys,
    in_ranges,
    lookup_key,
    one_per_key,
)
from txnstar.operators.projection import load_projection, timestamps_to_text, upper_columns
from txnstar.operators.star import (
    build_dim_account,
    build_dim_date,
    build_dim_merchant,
    build_dim_transaction_type,
    build_fact,
    transaction_types,
)
from txnstar.plans.jobs import (
    PipelineConfig,
    run_load,
    run_pipeline,
    run_transform,
    stage_star,
)
from txnstar.sources.raw import broken_rows, read_raw, read_raw_zone
from txnstar.sources.staged import current_root, new_version, read_staged, write_staged
from txnstar.sources.warehouse import create_warehouse, load_star, load_table, load_tables
from txnstar.streaming.ingest import ingest_landing, refused_files

__all__ = [
    "PipelineConfig",
    "assign_key",
    "assign_key_in_ranges",
    "build_dim_account",
    "build_dim_date",
    "build_dim_merchant",
    "build_dim_transaction_type",
    "build_fact",
    "calendar_parts",
    "cast_numbers",
    "clean_transactions",
    "create_warehouse",
    "drop_exact_duplicates",
    "drop_unparsed",
    "flag_suspicious",
    "hot_keys",
    "in_ranges",
    "ingest_landing",
    "refused_files",
    "load_projection",
    "load_star",
    "load_table",
    "load_tables",
    "lookup_key",
    "null_dates",
    "one_per_key",
    "parse_mixed_timestamps",
    "broken_rows",
    "current_root",
    "new_version",
    "read_raw",
    "read_raw_zone",
    "read_staged",
    "require_columns",
    "row_counts",
    "run_load",
    "run_pipeline",
    "run_transform",
    "stage_star",
    "standard_transactions",
    "timestamps_to_text",
    "transaction_types",
    "upper_columns",
    "write_staged",
]
