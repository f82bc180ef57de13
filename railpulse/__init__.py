"""Rail-sensor analytics on Spark: lazy ``DataFrame -> DataFrame`` operators."""
