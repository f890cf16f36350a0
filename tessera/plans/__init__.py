"""Plan-level helpers: iteration with checkpoints, size-checked broadcast,
the fixture views used by the registered queries, and the query registry."""
