"""Document and learner-trace analytics as composable PySpark operators."""
