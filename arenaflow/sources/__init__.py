"""Log scans, the test-table adapter, keyed text export/read-back, framed records."""
