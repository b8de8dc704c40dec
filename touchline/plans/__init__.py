"""The marts and pipelines, composed from operators."""
