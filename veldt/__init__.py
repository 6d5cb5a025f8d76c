"""veldt: DataFrame operators for everyday data-science work on Spark."""
