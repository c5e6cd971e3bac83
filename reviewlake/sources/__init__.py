"""Sources: table scans, landed payloads, CSV, word lists, in-memory rows, topics, models."""
