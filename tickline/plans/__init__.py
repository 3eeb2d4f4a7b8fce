"""Plans: the registered query catalog and the gated pipeline run."""
