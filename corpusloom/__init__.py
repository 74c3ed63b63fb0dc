"""corpusloom: corpus construction as Spark DataFrame transformations."""
