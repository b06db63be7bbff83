"""The commerce warehouse: rule book, layers, metrics, checks and releases."""
