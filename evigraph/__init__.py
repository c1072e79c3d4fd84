"""Evidence graphs and modeling tables as Spark DataFrame jobs."""
