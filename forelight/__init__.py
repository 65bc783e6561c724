"""forelight: ensemble-forecast analytics expressed as Spark DataFrame plans."""
