"""DataFrame-to-DataFrame operators; each one is a declarative Spark plan."""
