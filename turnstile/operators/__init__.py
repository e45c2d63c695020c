"""Reusable DataFrame operators: latest state, cleaning steps and dashboard roll-ups."""
