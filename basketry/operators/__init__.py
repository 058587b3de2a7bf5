"""Models: staging, facts, dimensions, aggregates, ranking, quality checks."""
