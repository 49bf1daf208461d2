"""DataFrame -> DataFrame steps of the marts (composable with ``DataFrame.transform``)."""
