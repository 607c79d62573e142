"""DataFrame operators for an entity vault on Spark."""
