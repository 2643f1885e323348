"""Settings for reading and writing ``s3a://`` paths."""

from __future__ import annotations


def s3a_settings(
    endpoint: str | None, access_key: str | None, secret_key: str | None
) -> dict[str, str]:
    """Settings for the session builder; empty unless all three values are given."""
    if not (endpoint and access_key and secret_key):
        return {}
    # Names of the settings.
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "true",
    }
