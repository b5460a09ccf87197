"""tillspark: retail analytics as Spark DataFrame plans."""
