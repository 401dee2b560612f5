"""clinflow: clinical-message analytics as Spark DataFrame jobs."""
