"""Reading and writing: delimited text, Bronze, versioned layer tables, logs."""
