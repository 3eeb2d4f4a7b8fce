"""Structured Streaming: Kafka (or same-shaped files) -> bronze, and the
incremental silver and bar queries."""
