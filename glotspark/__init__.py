"""Language identification of short texts as Spark DataFrame and Spark ML jobs."""
