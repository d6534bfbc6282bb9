"""Contract-gated table work on Spark: ingest drifting slices, profile them, gate them, report on them."""
