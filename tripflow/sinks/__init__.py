"""Write modes: versioned snapshots, partitioned upserts, JDBC loads, reports."""
