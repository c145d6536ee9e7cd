"""Supply-chain and trade-finance risk analytics as Spark DataFrame jobs."""
