"""tessera: record cleaning, deduplication, reconciliation and point sampling on Spark."""
