"""Layer jobs: bronze, silver and gold table loads and the config-driven run (PJ-01..PJ-07)."""
