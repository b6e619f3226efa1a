"""DataFrame to DataFrame steps: ingest, silver, the three marts, serving, censuses."""
