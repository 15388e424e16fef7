"""Named queries over the two fact tables: dashboard and data quality."""
