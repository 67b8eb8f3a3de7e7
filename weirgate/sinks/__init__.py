"""Writers: topics, stored tables, metrics."""
