"""docketry: a Spark-first engine for auditing, reconciling and publishing public-record tables."""
