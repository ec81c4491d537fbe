"""lading: remote files and endpoints in, DataFrames out -- and back.

Task code (``mapInPandas`` closures, the REST data source) is shipped to the
Python workers by value, so executors need no copy of this package on their
path; only pyspark, pandas and pyarrow, which Spark's Python workers have.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(sys.modules[__name__])


_EXPORTS = {
    "Reader": "lading.sources.files",
    "read_files": "lading.sources.files",
    "load_remote": "lading.sources.files",
    "latest_file": "lading.sources.files",
    "stage_files": "lading.sources.files",
    "Writer": "lading.operators.sink",
    "write_files": "lading.operators.sink",
    "deliver": "lading.operators.sink",
    "fetch_requests": "lading.operators.fetch",
    "fetch_to_staging": "lading.operators.fetch",
    "build_requests": "lading.operators.fetch",
    "read_rest": "lading.sources.rest",
    "post_rows": "lading.operators.post",
}


def __getattr__(name):
    """``from lading import Reader, Writer, ...`` without importing everything up front."""
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
