"""Table sources and sinks: CSV loaders for the hospital-shaped tables,
stop-word lists, single-file sinks and the driver test-table adapters."""
