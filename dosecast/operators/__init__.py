"""DataFrame-to-DataFrame steps of curation and forecast."""
