"""Sources and sinks: file manifest, table readers, archives, images, writers, artifacts."""
