"""Link discovery over web-page corpora, as Spark expressions."""
