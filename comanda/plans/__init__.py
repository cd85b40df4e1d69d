"""Star schema, query registry and the batch pipeline."""
