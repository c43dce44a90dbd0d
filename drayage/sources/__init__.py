"""Reading and writing of trees, logs, pages and archives."""
