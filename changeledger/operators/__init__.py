"""DataFrame -> DataFrame steps of the two jobs."""
