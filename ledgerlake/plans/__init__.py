"""Business reports and the query catalog."""
