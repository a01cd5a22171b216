"""Sources and sinks.

tables       -- ParquetTables, CatalogTables, JdbcTables (+ slice predicates, jdbc_url)
landing      -- Parquet / bucketed catalog landing laid out for pruning and co-location
testdata     -- ERP-shaped tables derived from the driver's test data
dictionaries -- code catalogues used by the test data
delivery     -- JSON encoding, batch numbering and envelopes, run log, snapshots
"""
