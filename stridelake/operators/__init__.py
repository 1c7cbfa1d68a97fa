"""DataFrame -> DataFrame steps (cleaning, lookups, star schema, profiling)."""
