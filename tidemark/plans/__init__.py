"""Plans: the feature registry and engine, contracts, storage of results, ingestion."""
