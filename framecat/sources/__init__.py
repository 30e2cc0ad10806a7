"""Sources: object listings, header prefixes, payload text, table reads."""
