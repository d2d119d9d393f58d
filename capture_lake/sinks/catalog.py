"""Spark settings for an Iceberg REST catalog (the table format option of W1/W2).

The settings are static session configuration: pass them to the launcher
(``spark-submit --conf k=v``) or to ``SparkSession.builder.config`` before the
session starts.  The Iceberg runtime jar must be on the classpath.
"""

from __future__ import annotations


def rest_catalog_conf(name: str, uri: str, warehouse: str, s3_endpoint: str = "",
                      s3_access_key: str = "", s3_secret_key: str = "") -> dict[str, str]:
    """Conf keys registering catalog ``name`` backed by a REST catalog at ``uri``.

    With an S3-compatible endpoint, path-style access is enabled; credentials
    are included only when given (instance roles need none).
    """
    prefix = f"spark.sql.catalog.{name}"
    conf = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "rest",
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse,
    }
    if s3_endpoint:
        conf[f"{prefix}.io-impl"] = "org.apache.iceberg.aws.s3.S3FileIO"
        conf[f"{prefix}.s3.endpoint"] = s3_endpoint
        conf[f"{prefix}.s3.path-style-access"] = "true"
    if s3_access_key:
        conf[f"{prefix}.s3.access-key-id"] = s3_access_key
    if s3_secret_key:
        conf[f"{prefix}.s3.secret-access-key"] = s3_secret_key
    return conf
