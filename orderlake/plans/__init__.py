"""Multi-stage plans: gold build, publish, DDL and the daily run."""
