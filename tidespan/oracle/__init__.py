"""The same queries as plain SQL (range joins, self joins), used only to check results."""
