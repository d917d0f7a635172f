"""Object-store (S3A-compatible) connector settings."""

from __future__ import annotations

import os
from collections.abc import Mapping

# Names of the settings read from the environment, and the
# region used when none is given.
ENV_ENDPOINT = "S3_ENDPOINT"
ENV_ACCESS_KEY = "S3_ACCESS_KEY"
ENV_SECRET_KEY = "S3_SECRET_KEY"
ENV_REGION = "S3_REGION"
DEFAULT_REGION = "us-east-1"


class MissingSettings(ValueError):
    pass


def s3a_conf(env: Mapping[str, str] | None = None, *, path_style: bool = True,
             ssl: bool = False, names: Mapping[str, str] | None = None) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible endpoint.

    ``names`` maps ``endpoint``, ``access_key``, ``secret_key`` and ``region``
    to the environment variables a deployment already uses (default
    ``S3_ENDPOINT``, ``S3_ACCESS_KEY``, ``S3_SECRET_KEY``, ``S3_REGION``).
    Every missing variable is named in one error; secrets are returned for the
    session builder but never logged or placed in an error message.  Apply once
    when the session is built (``SparkSession.builder.config(map=...)``)."""
    env = os.environ if env is None else env
    n = {"endpoint": ENV_ENDPOINT, "access_key": ENV_ACCESS_KEY, "secret_key": ENV_SECRET_KEY,
         "region": ENV_REGION, **(names or {})}
    required = (n["endpoint"], n["access_key"], n["secret_key"])
    missing = [k for k in required if not env.get(k)]
    if missing:
        raise MissingSettings(f"missing environment variables: {', '.join(missing)}")
    p = "spark.hadoop.fs.s3a."
    return {
        p + "endpoint": env[n["endpoint"]],
        p + "endpoint.region": env.get(n["region"]) or DEFAULT_REGION,
        p + "access.key": env[n["access_key"]],
        p + "secret.key": env[n["secret_key"]],
        p + "path.style.access": str(path_style).lower(),
        p + "connection.ssl.enabled": str(ssl).lower(),
        p + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        p + "aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    }


def redacted(conf: Mapping[str, str]) -> dict[str, str]:
    """The same settings with keys and secrets masked, safe to print."""
    return {k: ("***" if ("key" in k or "secret" in k) else v) for k, v in conf.items()}
