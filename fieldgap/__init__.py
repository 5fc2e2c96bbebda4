"""Vehicle-safety and parts-coverage analytics on the PySpark DataFrame API."""
