"""lingotile: Spark-native multilingual tokenisation and language identification."""

__version__ = "0.1.0"
