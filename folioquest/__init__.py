"""A Spark-native engine that turns documents into question-answer datasets."""
