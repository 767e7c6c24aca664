"""DataFrame operators: cleaning, de-duplication, quality metrics, ingest, gold shapes."""
