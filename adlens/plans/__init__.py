"""The named-query catalog (default parameters, SQL view registration) and
plan-inspection helpers."""
