"""Event-queue analytics on Spark: ordered reads, envelopes, batching, joins, state and lineage."""
