"""DataFrame -> DataFrame operators: lines, documents, vocabulary, metrics, samples."""
