"""File scans and sinks."""
