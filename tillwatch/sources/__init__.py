"""Where records come from: message broker, record files and given tables."""
