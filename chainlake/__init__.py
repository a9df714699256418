"""A Spark-native engine for block-chain tables, and operators for training data in ``chainlake.llm``."""
