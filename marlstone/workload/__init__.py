"""The registered queries, the raw inputs they read, and the SQL they are checked against."""
