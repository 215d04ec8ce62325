"""The jobs: each takes frames and returns frames. Only ``refresh`` reads and writes."""
