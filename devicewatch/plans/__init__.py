"""Layer by layer composition, and the registered queries."""
