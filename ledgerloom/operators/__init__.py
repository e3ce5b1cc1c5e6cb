"""DataFrame operators: snapshots, lookups, concept roll-ups, quality, profiling, text."""
