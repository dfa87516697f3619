"""evidentia: a Spark-native engine for news-event evidence, series and training-text work."""
