"""Provider account analytics on Spark: ingest, star schema, KPI views, trends, benchmarks, audits, measures."""
