"""Order analytics as Spark jobs: CSV extracts, staging, dimensions, facts, rules."""
