"""Reading and writing: stored tables, the event topic, partitioned datasets."""
