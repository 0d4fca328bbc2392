"""Data products: functions of (current rows, history rows, dimensions), without I/O."""
