"""Daily account balances and interest as Spark DataFrame plans."""
