"""Jobs that write: sinks, the run log, slice ingestion and the contract gate."""
