"""DataFrame operators: rules, keys, duplicates, rollups, audit, scoring, retrieval, text."""
