"""End-to-end compositions (pipelines) and the registry of named queries."""
