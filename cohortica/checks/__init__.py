"""Checked queries: each Spark job next to the SQL that must give the same rows."""
