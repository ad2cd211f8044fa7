"""DataFrame -> DataFrame operators (projections, filters, joins, aggregates, reshaping)."""
