"""Query plans: the pipeline context, reports and the query catalog."""
