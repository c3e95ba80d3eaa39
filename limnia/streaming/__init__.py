"""The file-by-file loop as an incremental stream."""
