"""A text-sentiment warehouse as Spark DataFrame transforms."""
