"""Table operators: star schema, dimension joins, quality checks, features, models, metrics."""
