"""DataFrame -> DataFrame operators: cleaning, quality checks, gold aggregates."""
