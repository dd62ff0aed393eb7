"""Network-behaviour analytics written as Spark DataFrame jobs."""
