"""Unit tests; a package, so that files of one name can be collected beside those in llm."""
