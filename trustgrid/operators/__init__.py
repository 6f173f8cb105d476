"""DataFrame operators: reshape, lookups, scoring, quality, geo, fixes."""
