"""DataFrame operators: lookups, joins, aggregations, transforms, request plans, reports."""
