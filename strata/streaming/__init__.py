from strata.streaming.ingest import ingest_stream  # noqa: F401
