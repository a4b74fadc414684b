"""Event-log pipelines and process analytics as Spark DataFrame plans."""
