"""Jobs, catalog statements and the registered queries."""
