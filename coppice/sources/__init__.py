"""Feature tables, prediction files, search result files and the tracking tables."""
