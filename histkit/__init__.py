"""Build and maintain historical dimensions from change-event tables with PySpark."""
