"""Lazy plans: inventory, sync plan, rendered definitions, merged version."""
