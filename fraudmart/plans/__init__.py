"""Composite jobs: the fraud mart, the daily pipeline, the test-table adapter and
the registered checks with their SQL twins."""
