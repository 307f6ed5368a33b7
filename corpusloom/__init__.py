"""Text analytics over large document collections, written as Spark DataFrame jobs."""
