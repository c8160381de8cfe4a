"""Landed files in, warehouse tables out."""
