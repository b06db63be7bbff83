"""Column-level helpers: parsing, ratios, rejection rules and mergeable measures."""
