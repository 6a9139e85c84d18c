"""quipuflow: a Spark-native engine that turns pages into curated triples and reports."""
