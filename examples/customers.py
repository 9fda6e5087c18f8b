"""Three customers through all layers.

    python examples/customers.py <base_path>
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from layerloom import LayerConfig, operators, plans, sinks, sources  # noqa: E402

# The sample customers with their columns, and the settings document.
CUSTOMER_SCHEMA = "id string, name string, email string, created_date string, status string"
CUSTOMERS = [
    ("1", "John Doe", "john@email.com", "2024-01-01", "active"),
    ("2", "Jane Smith", "jane@email.com", "2024-01-02", "inactive"),
    ("3", "Bob Johnson", "bob@email.com", "2024-01-03", "active"),
]
SETTINGS = [("1.0", "2024-01-01T10:00:00Z", (1000, 30))]
SETTINGS_SCHEMA = (
    "pipeline_version string, last_run string, "
    "settings struct<batch_size: bigint, retention_days: bigint>"
)


def main(base_path: str) -> None:
    spark = SparkSession.builder.appName("customers").getOrCreate()
    config = LayerConfig(base_path)

    raw = sources.literal_rows(spark, CUSTOMERS, CUSTOMER_SCHEMA)
    sinks.show(plans.run(raw, config, plans.CUSTOMERS))

    files = sources.file_inventory(spark, config.layer_path("bronze"))
    sinks.show(operators.row_count(files, "bronze_files"))
    sinks.show(operators.first_n(files, 5, F.col("name")))

    settings = sources.literal_rows(spark, SETTINGS, SETTINGS_SCHEMA)
    path = sinks.write_json_documents(settings, config.temp_path("settings"))
    sinks.show(sources.read_json_document(spark, path, SETTINGS_SCHEMA))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
