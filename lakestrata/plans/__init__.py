"""Warehouse plans: current-state tables, dimensions, facts, serving views, the run order."""
