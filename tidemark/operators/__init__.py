"""DataFrame operators: staging, loading, extraction, audit, regression."""
