"""A PySpark engine for configuration-driven calculation over tagged time series."""
