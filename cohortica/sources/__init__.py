"""Reading tables and writing audiences."""
