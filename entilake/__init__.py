"""Analytics over entity dumps and revision histories, written as PySpark DataFrame plans."""
