"""Column functions: text rules, wire format, event time and message rendering."""
