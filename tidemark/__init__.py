"""Account-lifecycle analytics as Spark DataFrame operators."""
