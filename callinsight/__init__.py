"""callinsight: customer-support call analytics as distributed Spark DataFrame queries."""
