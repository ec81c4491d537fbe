"""File types, option normalisation and per-format defaults.

Everything here runs on the driver and only shapes reader/writer options; the
scans and writes themselves are Spark's native file sources, so column pruning,
filter pushdown, vectorised parquet and split-parallel reads come for free.
"""

from __future__ import annotations

from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.errors import AnalysisException

# The accepted file types, in the connector's order.
FILE_TYPES = ("csv", "json", "avro", "parquet", "txt", "xml")

# MIME-style spellings accepted for a file type.
MIME_ALIASES = {
    "application/json": "json",
    "text/csv": "csv",
    "text/plain": "txt",
    "application/xml": "xml",
    "text/xml": "xml",
    "application/avro": "avro",
    "application/parquet": "parquet",
}

# Connector defaults that differ from Spark's own.
CONNECTOR_DEFAULTS = {
    "header": "true",
    "delimiter": ",",
    "inferSchema": "false",
    "createDF": "true",
    "copyLatest": "false",
    "cryptoAlgorithm": "AES",
}

# The connector's error messages for missing or unknown options.
MSG_NO_PATH = "'path' must be specified"
MSG_NO_FILE_TYPE = "File type has to be provided using 'fileType' option"
MSG_BAD_FILE_TYPE = "fileType {value} not supported. Supported file types are {supported}"

# Lossless text round trips: Spark's default timestamp patterns keep only
# milliseconds; these keep the microseconds parquet and the tables carry.
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_LTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

XML_ROWS_PER_FILE = 50_000

# Option keys the connector consumes itself; never handed to a Spark reader.
CONNECTOR_KEYS = {
    "filetype", "createdf", "copylatest", "templocation", "hdfstemplocation",
    "staginglocation", "cryptokey", "cryptoalgorithm", "cryptokeyfile",
    "cryptokeyid", "host", "port", "username", "password", "pem",
    "pempassphrase", "stage", "latestby", "protocol", "singlefile",
}

_SPARK_FORMAT = {
    "csv": "csv",
    "json": "json",
    "parquet": "parquet",
    "txt": "text",
    "xml": "xml",
    "avro": "avro",
}

# The avro source is bundled with Spark but its short name is only registered
# when the module is deployed as a package; the file format class itself is
# on the stock classpath, so fall back to it.
AVRO_CLASS = "org.apache.spark.sql.avro.AvroFileFormat"


def file_type(value: str | None) -> str:
    """Validate and normalise a ``fileType`` option value."""
    if value is None or str(value).strip() == "":
        raise ValueError(MSG_NO_FILE_TYPE)
    ft = MIME_ALIASES.get(str(value).strip().lower(), str(value).strip().lower())
    if ft not in FILE_TYPES:
        raise ValueError(MSG_BAD_FILE_TYPE.format(value=value, supported=list(FILE_TYPES)))
    return ft


def spark_format(ft: str) -> str:
    return _SPARK_FORMAT[file_type(ft)]


def normalise(options: dict | None) -> dict[str, str]:
    """Case-insensitive option map with string values, aliases folded in."""
    out: dict[str, str] = {}
    refuse(options or {})
    for key, value in (options or {}).items():
        if value is None:
            continue
        if isinstance(value, bool):
            value = "true" if value else "false"
        out[str(key)] = str(value)
    lower = {k.lower(): k for k in out}
    # tempLocation / hdfsTempLocation both name the staging folder.
    for alias in ("hdfstemplocation", "templocation"):
        if alias in lower and "staginglocation" not in lower:
            out["stagingLocation"] = out[lower[alias]]
            lower["staginglocation"] = "stagingLocation"
    return out


def get(options: dict, key: str, default=None):
    want = key.lower()
    for k, v in options.items():
        if k.lower() == want:
            return v
    return default


def flag(options: dict, key: str, default: str = "false") -> bool:
    return str(get(options, key, default)).strip().lower() == "true"


def refuse(options: dict) -> None:
    """Options that would silently not do what they say."""
    if get(options, "pemPassphrase") is not None:
        raise ValueError("pemPassphrase is not supported: the SFTP filesystem reads unencrypted key files only")


def spark_options(options: dict) -> dict[str, str]:
    return {k: v for k, v in options.items() if k.lower() not in CONNECTOR_KEYS}


def read_options(ft: str, options: dict) -> dict[str, str]:
    """Reader options for one file type: connector defaults + user options."""
    user = spark_options(options)
    base: dict[str, str] = {}
    if ft == "csv":
        base = {
            "header": CONNECTOR_DEFAULTS["header"],
            "delimiter": CONNECTOR_DEFAULTS["delimiter"],
            "inferSchema": CONNECTOR_DEFAULTS["inferSchema"],
        }
    # No timestamp pattern on read: Spark's default parser takes the ISO text
    # the writer emits (microseconds included) exactly, and is ~2x faster.
    if ft == "xml" and get(user, "rowTag") is None:
        raise ValueError("fileType xml needs the 'rowTag' option")
    if ft == "xml" and not flag(user, "multiLine", "true"):
        raise ValueError("xml is read whole-file: multiLine=false would split records between tasks and repeat them")
    return _merge(base, user)


def write_options(ft: str, options: dict) -> dict[str, str]:
    """Writer options for one file type: lossless defaults + user options."""
    user = spark_options(options)
    base: dict[str, str] = {}
    if ft == "csv":
        base = {
            "header": CONNECTOR_DEFAULTS["header"],
            "delimiter": CONNECTOR_DEFAULTS["delimiter"],
            # Spark's csv writer trims blanks unless told not to.
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }
        codec = get(user, "codec")
        if codec is not None:
            user = {k: v for k, v in user.items() if k.lower() != "codec"}
            base["compression"] = codec
    if ft in ("csv", "json", "xml"):
        base["timestampNTZFormat"] = TS_NTZ_FORMAT
        base["timestampFormat"] = TS_LTZ_FORMAT
    if ft == "xml":
        # xml is read whole-file (not splittable): bounded files keep later
        # scans parallel instead of one task per writer partition.
        base["maxRecordsPerFile"] = str(XML_ROWS_PER_FILE)
    return _merge(base, user)


def _merge(base: dict, user: dict) -> dict:
    lower = {k.lower() for k in user}
    merged = {k: v for k, v in base.items() if k.lower() not in lower}
    merged.update(user)
    return merged


def load_with(reader: DataFrameReader, ft: str, path):
    """``reader.load(path)`` for a file type, with the avro class fallback."""
    fmt = spark_format(ft)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as exc:
        if ft == "avro" and "avro" in str(exc).lower() and "data source" in str(exc).lower():
            return reader.format(AVRO_CLASS).load(path)
        raise


def save_with(writer: DataFrameWriter, ft: str, path: str) -> None:
    fmt = spark_format(ft)
    try:
        writer.format(fmt).save(path)
    except AnalysisException as exc:
        if ft == "avro" and "avro" in str(exc).lower() and "data source" in str(exc).lower():
            writer.format(AVRO_CLASS).save(path)
            return
        raise
