"""finloom: financial-statement analytics and corpus preparation as Spark DataFrame plans."""
