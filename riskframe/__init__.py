"""Credit-risk analytics on account tables, expressed as Spark DataFrame operators."""
