"""Rules, tagging, joins, aggregations, sampling, evaluation and learners."""
