"""The plans of each layer, from landed pages to marts and reports."""
