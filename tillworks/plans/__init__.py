"""Query plans, one function per catalogue entry."""
