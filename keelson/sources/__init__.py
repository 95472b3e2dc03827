"""Table sources, scans and artefact sinks."""
