"""Connector-style remote locations: ``host``/``port``/``path`` options to a URI.

The connector names a remote file by ``host``, ``port`` (default 22) and
``path``, with ``username``/``password`` or a ``pem`` key file.  Here the
transport is whatever Hadoop FileSystem serves the URI's scheme: the options
become an ``sftp://user@host:port/path`` URI (``protocol`` picks another
scheme) and the credentials become that filesystem's Hadoop settings, so they
are never part of a plan, a column or a path string.
"""

from __future__ import annotations

from urllib.parse import quote, urlparse

from pyspark.sql import SparkSession

from . import formats

DEFAULT_PORT = "22"
SFTP_IMPL = "org.apache.hadoop.fs.sftp.SFTPFileSystem"


def remote_uri(path: str, options: dict) -> str:
    """URI for ``path``: unchanged if it has a scheme or no ``host`` option is set."""
    if not path:
        raise ValueError(formats.MSG_NO_PATH)
    host = formats.get(options, "host")
    if host is None or urlparse(path).scheme:
        return path
    scheme = formats.get(options, "protocol", "sftp")
    port = formats.get(options, "port", DEFAULT_PORT)
    user = formats.get(options, "username")
    who = f"{quote(user, safe='')}@" if user else ""
    return f"{scheme}://{who}{host}:{port}/{path.lstrip('/')}"


def hadoop_settings(options: dict) -> dict[str, str]:
    """Hadoop SFTPFileSystem settings for the connector's login options."""
    host = formats.get(options, "host")
    if host is None or formats.get(options, "protocol", "sftp") != "sftp":
        return {}
    out = {"fs.sftp.impl": SFTP_IMPL,
           f"fs.sftp.host.port": formats.get(options, "port", DEFAULT_PORT)}
    user = formats.get(options, "username")
    if user:
        out[f"fs.sftp.user.{host}"] = user
        password = formats.get(options, "password")
        if password:
            out[f"fs.sftp.password.{host}.{user}"] = password
    pem = formats.get(options, "pem")
    if pem:
        out["fs.sftp.keyfile"] = pem
    return out


def configure(spark: SparkSession, options: dict) -> None:
    """Put the login settings into the session's Hadoop configuration."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in hadoop_settings(options).items():
        conf.set(key, value)


def resolve(spark: SparkSession, path, options: dict):
    """Configure the transport for ``options`` and return the URI(s) to scan or write."""
    if path is not None and not isinstance(path, str):
        return [resolve(spark, p, options) for p in path]
    uri = remote_uri(path, options)
    if uri != path:
        configure(spark, options)
    return uri
