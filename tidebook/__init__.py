"""tidebook: order-book and trade-tape analytics expressed as Spark DataFrame functions."""
