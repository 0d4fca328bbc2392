"""Micro-batch wiring: state logs, the retail stream, and notification output."""
