from tallyframe.sources.delimited import (
    examples_of,
    load_labelled,
    load_sifted,
    parse_labelled,
    probe_header,
    read_lines,
    rejected_lines,
    rejects_of,
    sift,
    split_fields,
    strip_header,
)
from tallyframe.sources.fit_records import FitRecord, input_state, read_record, write_record
from tallyframe.sources.saved_models import load_model, load_models, save_model, save_models

__all__ = [
    "FitRecord",
    "examples_of",
    "input_state",
    "load_labelled",
    "load_model",
    "load_models",
    "load_sifted",
    "parse_labelled",
    "probe_header",
    "read_lines",
    "read_record",
    "rejected_lines",
    "rejects_of",
    "save_model",
    "save_models",
    "sift",
    "split_fields",
    "strip_header",
    "write_record",
]
