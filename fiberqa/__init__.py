"""Quality assurance of multi-fiber spectroscopic data as Spark DataFrame jobs."""
