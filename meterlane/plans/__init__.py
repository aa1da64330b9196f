"""Stand-in tables and the registered queries that exercise every operator on them."""
