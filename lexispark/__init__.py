"""lexispark: terminology mining, curation and corpus preparation on Spark."""
