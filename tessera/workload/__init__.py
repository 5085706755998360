"""The driver's tables in the roles of the sources, and the registered queries."""
