"""Sources: bronze JSON readers, driver-table adapters, dimension tables, record schemas."""
