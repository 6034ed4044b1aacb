"""Change-data synchronisation on PySpark: envelopes, net changes, keyed apply, state and verification."""
