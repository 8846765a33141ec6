"""Customer analytics and feature engineering as Spark DataFrame jobs."""
