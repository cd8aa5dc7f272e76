"""Foreign-trade analytics as Spark DataFrame plans."""
