"""DataFrame operators: columns, filters, joins, aggregates, ordering, reshape, unions."""
