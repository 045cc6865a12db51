"""Structured Streaming: envelope sources, parsing, enrichment and the keyed upsert sink."""
