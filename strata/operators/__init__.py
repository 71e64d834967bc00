"""DataFrame operators by layer: bronze, silver, gold, tables, state, ml, gate."""
