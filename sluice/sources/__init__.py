"""Sources: log-shaped and row-producer inputs, batch and streaming."""
