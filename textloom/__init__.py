"""textloom: text-corpus analytics as Spark DataFrame transformations."""
