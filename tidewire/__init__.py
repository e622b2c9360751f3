"""Content-intelligence operators for article streams, expressed as Spark DataFrame plans."""
