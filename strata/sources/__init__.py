from strata.sources.files import (  # noqa: F401
    delete_path,
    discover_sources,
    ingest_file,
    list_files,
    parquet_schema,
    raw_completeness,
    read_csv,
    read_split_csv,
    read_parquet,
    scratch_path,
    source_manifest,
    validate_raw_layer,
    write_csv,
    write_parquet,
)
