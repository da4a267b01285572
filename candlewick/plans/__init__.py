"""Jobs that work out what to fetch."""
