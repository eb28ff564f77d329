"""refinery: PySpark operators for refining catalogue data on tables."""
