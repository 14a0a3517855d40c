"""Session analytics on web-shop event logs, written as Spark DataFrame operators."""
