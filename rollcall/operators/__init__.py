"""DataFrame operators: linking, merging, enrichment, scoring, filtering."""
