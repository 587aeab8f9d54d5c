"""The operators: view stages, aggregations, mutations, schema, quality, evaluation."""
