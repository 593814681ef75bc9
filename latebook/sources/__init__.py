"""Sources: raw files, landing folders, extraction contracts, message payloads, tables."""
