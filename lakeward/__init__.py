"""lakeward: governed batch pipelines (landing, staging, CDC, PII masking,
data contracts) written as plain Spark DataFrame code."""

__version__ = "0.1.0"
