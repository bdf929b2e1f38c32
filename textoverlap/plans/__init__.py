"""User-level jobs (compare two documents, a corpus, two corpora, numbered
lines) and the registry of named queries with their SQL oracles."""
