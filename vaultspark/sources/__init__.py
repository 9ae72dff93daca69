"""Sources: scans of source systems and staging tables, landed files, table store."""
