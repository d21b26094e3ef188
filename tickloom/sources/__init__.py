"""Table storage, landed raw feeds and the views over the supplied tables."""
