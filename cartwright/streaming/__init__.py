"""The rule book and hourly activity over arriving files."""
