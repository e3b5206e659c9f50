"""The five batch flows: read, transform, write."""
