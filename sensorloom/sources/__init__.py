"""Reading and writing: message formats, Kafka, JDBC, HTTP, change logs, generated series."""
