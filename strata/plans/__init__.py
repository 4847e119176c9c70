"""Model plans: silver and gold models, the build DAG, extraction, driver queries."""
