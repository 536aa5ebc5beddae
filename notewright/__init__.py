"""Record search and corpus preparation on PySpark."""

import sys

from pyspark import cloudpickle

from notewright.operators.search import Dataset
from notewright.plans.corpus import (
    catalogue_folder,
    convert_workbooks,
    load_dataset,
    read_workbooks,
    records_of_pattern,
    rewrite_folder,
    trim_folder,
)
from notewright.plans.embedding import embed_folder, numbered_texts
from notewright.session import build_session
from notewright.sources.jsonl import parse_records, read_records, scan_objects, scan_rejects

# Functions that run in Python workers travel with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "Dataset",
    "build_session",
    "catalogue_folder",
    "convert_workbooks",
    "embed_folder",
    "load_dataset",
    "numbered_texts",
    "parse_records",
    "read_records",
    "read_workbooks",
    "records_of_pattern",
    "rewrite_folder",
    "scan_objects",
    "scan_rejects",
    "trim_folder",
]
