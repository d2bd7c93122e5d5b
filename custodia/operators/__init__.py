"""Table operators: joins, quality, compliance, dead letters, service analytics."""
