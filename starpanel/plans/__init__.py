"""Plans: loads, the panel, reports, guards and the registry of queries."""
