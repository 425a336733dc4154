"""Web-shop clickstream analytics as plain DataFrame functions on Spark."""
