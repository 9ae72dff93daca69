"""Plans: the daily pipeline and the catalog of registered queries."""
