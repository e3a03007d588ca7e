"""Daily news sentiment against price moves, as composable Spark DataFrame operators."""
