"""quire: a Spark-native engine for document-archive catalogues and text corpora."""
