"""playlens: game-operations analytics as composable Spark DataFrame operators."""
