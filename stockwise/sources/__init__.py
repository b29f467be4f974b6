"""Reading and writing partitioned datasets, tables and typed marts."""
