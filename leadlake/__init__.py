"""leadlake: outreach-lead analytics as distributed PySpark DataFrame operators."""
