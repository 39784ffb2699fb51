"""Table contracts, readers and writers."""

from aduana.sources.contracts import (
    COMTRADE, DIMENSIONS, ORGANISATION, PLANNING, STAR, STAR_ORGANISATION_FACT, STAR_PLANNING_FACT, Contract,
    conform, create_table,
)
from aduana.sources.readers import (
    header_names, latest_day, promote_header, read_csv, read_csv_with_rejects, read_facts, read_header_json, read_header_records, read_latest,
    read_parquet, read_parquet_tree, read_source, unreadable_records, unreadable_responses,
)
from aduana.sources.writers import (
    concat_extracts, ingest_extracts, ingest_facts, update_facts, write_csv, write_facts, write_parquet,
)

__all__ = [
    "COMTRADE", "DIMENSIONS", "ORGANISATION", "PLANNING", "STAR", "STAR_ORGANISATION_FACT", "STAR_PLANNING_FACT",
    "Contract", "concat_extracts", "conform", "create_table", "header_names", "ingest_extracts", "ingest_facts", "latest_day",
    "promote_header", "read_csv", "read_csv_with_rejects", "read_facts", "read_header_json", "read_header_records", "read_latest",
    "read_parquet", "read_parquet_tree", "read_source", "unreadable_records", "unreadable_responses", "update_facts",
    "write_csv", "write_facts", "write_parquet",
]
