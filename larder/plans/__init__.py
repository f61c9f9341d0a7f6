"""The table jobs: landing, Silver, Gold, model."""
