"""strandlake: sequencing-read analytics as Spark DataFrame jobs."""
