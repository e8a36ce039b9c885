"""tidemark: a Spark-native engine for auditing labelled, lineage-tracked datasets."""

__version__ = "0.1.0"
