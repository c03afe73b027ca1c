"""DataFrame -> DataFrame operators: joins, aggregates, upserts, evaluation."""
