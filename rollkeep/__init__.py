"""PySpark operators for lists that are published as full snapshots: read, resolve, dedup, version, search, compare."""
