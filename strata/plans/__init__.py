"""End-to-end pipeline, and the registry of queries with their SQL oracles."""
