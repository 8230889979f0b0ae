"""Column-level rules: text standardisation, change hashes, calendar helpers, masking."""
