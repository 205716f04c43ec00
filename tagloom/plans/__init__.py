"""Composite plans: tag models, the model runner, the scenario over the test tables, queries."""
