"""Plans: silver / gold builds, report queries and the query catalog."""
