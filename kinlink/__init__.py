"""kinlink: record linkage and data processing expressed as Spark DataFrame plans."""
