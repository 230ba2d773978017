"""Reading and writing: delimited files, staging, exports and published snapshots."""
