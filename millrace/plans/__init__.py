"""Physical layout helpers: skew-safe ordered scans, salted joins, shared staging folders."""
