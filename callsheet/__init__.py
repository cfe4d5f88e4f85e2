"""Contact extraction on Spark: DataFrame operators from stored web pages and a
company table to ranked phone contacts and run reports."""
