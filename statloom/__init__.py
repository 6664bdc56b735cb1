"""statloom: tabular statistics and model fitting as Spark DataFrame operators."""
