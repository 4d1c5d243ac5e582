"""A PySpark engine that turns scanned or extracted reference works into tables."""
