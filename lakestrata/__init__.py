"""lakestrata: a layered (landing -> current state -> star schema) warehouse on plain Spark."""

__version__ = "0.1.0"
