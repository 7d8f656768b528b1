"""Clinical-document analytics as Spark DataFrame operators."""
