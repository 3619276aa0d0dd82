"""Table readers and writers, scratch locations and test-table bindings."""
