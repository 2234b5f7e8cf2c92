"""Card-domain inputs derived from the given tables, the registered queries and their SQL counterparts."""
