"""Sources: the driver's parquet tables, the business tables derived from
them, typed schemas, and the schedule / code-table loaders."""
