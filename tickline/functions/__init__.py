"""Column-level building blocks: validity rules, time buckets, finance math."""
