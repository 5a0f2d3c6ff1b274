"""credlake: Spark-native credit-risk analytics (DataFrame -> DataFrame operators)."""

__version__ = "0.1.0"
