"""From SQL text to Spark SQL: lexing, statement splitting and dialect rewrites."""
