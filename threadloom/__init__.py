"""Discussion analytics on Spark: ingest, flatten, enrich, cluster, label and project threaded discussions."""
