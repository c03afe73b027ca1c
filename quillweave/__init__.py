"""quillweave: a Spark-native literature-mining and knowledge-graph engine."""
