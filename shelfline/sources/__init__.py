"""Sources: lake layout, files, JDBC, snapshot tables, and the test-table adapter."""
