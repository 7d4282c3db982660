"""Writers: stage tables, row payloads, keyed logs."""
