"""hillwarden: geohazard early-warning analytics as Spark DataFrame jobs."""
