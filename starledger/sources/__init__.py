"""Raw record schemas, readers, page merging, raw snapshots and tables."""
