"""FHIR R4 bundle lakehouse as lazy PySpark DataFrame transformations."""
