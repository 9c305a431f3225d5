"""DataFrame operators: predicates, joins, aggregates, windows, table changes."""
