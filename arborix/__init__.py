"""arborix: Spark-native rule-tree analytics."""
