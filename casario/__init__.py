"""Property-listing analytics on PySpark: extract, clean, enrich, aggregate, report."""
