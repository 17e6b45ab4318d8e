"""DataFrame operators: cleaning, joins, ordering, dimensions, history, quality."""
