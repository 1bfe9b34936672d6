"""Flow configuration: options by name to validated dataclasses.

`fileComparator` of other collectors is here `order`, named by what it does: `oldest_first`
reads files by ascending time, `newest_first` by descending time.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from logloom.functions.converters import REGISTRY, ascii_only
from logloom.operators.batching import LIMITS
from logloom.operators.framing import MAX_RECORD


@dataclass(frozen=True)
class Flow:
    """One file pattern and its destination. Sizes are bytes, times milliseconds unless named."""

    file_pattern: str
    destination: str
    kind: str = "stream"
    enable: bool = True
    initial_position: str = "START_OF_FILE"
    skip_header_lines: int = 0
    record_delimiter: str = "\n"
    file_encoding: str = "UTF-8"
    multi_line_start_pattern: str | None = None
    truncated_record_terminator: str | None = None
    remain_record_delimiter: bool = False
    ignore_empty_data: bool = True
    header_bytes_length: int = 512
    sending_threads: int = 1
    result_log_level: str = "INFO"
    file_suffix: str = ".COMPLETED"
    file_move_to_dir: str = ""
    delete_policy: str = "never"
    file_appendable: bool = True
    miss_last_record_delimiter: bool = False
    max_file_checking_millis: int = 500
    ignore_not_updated_file_seconds: int = -1
    directory_recursion: bool = False
    order: str = "oldest_first"
    data_processing_options: tuple[dict[str, Any], ...] = ()
    partition_key_option: str = "RANDOM_INT"
    stream_type: str = "COMMON"
    max_buffer_age_millis: int = 5000
    max_buffer_size_records: int = 500
    max_buffer_size_bytes: int = 4 << 20
    retry_initial_backoff_millis: int = 100
    retry_max_backoff_millis: int = 10_000
    min_time_between_polls_millis: int = 100
    dump_directory: str = ""
    upload_full_path: bool = False
    checkpoint_time_to_live_days: int = 7

    def __post_init__(self) -> None:
        def need(ok: bool, what: str) -> None:
            if not ok:
                raise ValueError(f"flow {self.file_pattern!r}: {what}")

        need(bool(self.file_pattern), "filePattern is required")
        need(bool(self.destination), "a destination is required")
        need(self.kind in LIMITS, f"kind is one of {sorted(LIMITS)}")
        need(self.initial_position in ("START_OF_FILE", "END_OF_FILE"), "initialPosition is START_OF_FILE or END_OF_FILE")
        need(self.skip_header_lines >= 0, "skipHeaderLines is not negative")
        object.__setattr__(self, "record_delimiter", ascii_only(self.record_delimiter))
        need(1 <= self.max_buffer_size_records <= LIMITS[self.kind]["max_records"], "maxBufferSizeRecords is out of range")
        need(1 <= self.max_buffer_size_bytes <= LIMITS[self.kind]["bytes"], "maxBufferSizeBytes is out of range")
        need(500 <= self.max_buffer_age_millis <= 15 * 60 * 1000, "maxBufferAgeMillis is half a second to a quarter of an hour")
        need(self.stream_type in MAX_RECORD, f"streamType is one of {sorted(MAX_RECORD)}")
        need(len((self.truncated_record_terminator or "").encode()) < MAX_RECORD["COMMON"], "truncatedRecordTerminator is too long")
        need(0 < self.retry_initial_backoff_millis <= self.retry_max_backoff_millis, "backoff times are out of order")
        need(self.order in ("oldest_first", "newest_first"), "order is oldest_first or newest_first")
        need(self.delete_policy in ("never", "immediate"), "deletePolicy is never or immediate")
        need(self.header_bytes_length >= 0, "headerBytesLength is not negative")
        for o in self.data_processing_options:
            need(str(o.get("optionName", "")).upper() in REGISTRY, f"unknown converter {o.get('optionName')!r}")
        # never shorter than the poll interval
        object.__setattr__(self, "max_file_checking_millis", max(self.max_file_checking_millis, self.min_time_between_polls_millis))

    @property
    def id(self) -> str:
        return f"{self.kind}:{self.file_pattern}:{self.destination}"

    @property
    def max_record_bytes(self) -> int:
        return MAX_RECORD[self.stream_type]

    @property
    def converters(self) -> list[dict[str, Any]]:
        return list(self.data_processing_options) or [{"optionName": "SINGLELINE"}]

    @property
    def log_level(self) -> int | None:
        """The level at which results are logged; None is off, an unknown name is INFO."""
        import logging

        name = str(self.result_log_level).upper()
        return None if name in ("OFF", "FALSE") else {"TRACE": 5, "DEBUG": 10, "INFO": 20, "WARN": 30, "ERROR": 40}.get(name, logging.INFO)


#: Names of options that aren't the field's name in camel case.
RENAMED = {"isRemainRecordDelimiter": "remain_record_delimiter", "isIgnoreEmptyData": "ignore_empty_data", "isFileAppendable": "file_appendable", "isMissLastRecordDelimiter": "miss_last_record_delimiter", "sendingThreadSize": "sending_threads", "directoryRecursionEnabled": "directory_recursion", "ignoreNotUpdatedFileSeconds": "ignore_not_updated_file_seconds", "minTimeBetweenFilePollsMillis": "min_time_between_polls_millis", "retryInitialBackoffMillis": "retry_initial_backoff_millis"}


def snake(name: str) -> str:
    return RENAMED.get(name) or re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def flow(options: dict[str, Any]) -> Flow:
    """A flow of its options; values of numbers and booleans may be text. Unknown options are
    ignored."""
    o = dict(options)
    kind, destination = ("object_store", o.get("objectStore")) if "objectStore" in o else ("stream", o.get("stream"))
    values: dict[str, Any] = {"kind": o.pop("kind", kind), "destination": o.pop("destination", destination) or ""}
    if values["kind"] == "object_store":
        values |= {"max_buffer_size_records": 1, "max_buffer_size_bytes": LIMITS["object_store"]["bytes"], "sending_threads": 10, "file_appendable": False, "min_time_between_polls_millis": 1000}
    kinds = {f.name: f.type for f in Flow.__dataclass_fields__.values()}
    for name, value in o.items():
        if (key := snake(name)) in kinds:
            kind_of = str(kinds[key])
            if kind_of == "bool" and isinstance(value, str):
                value = value.strip().lower() == "true"
            elif kind_of == "int" and isinstance(value, str):
                value = int(value)
            elif key == "data_processing_options":
                value = tuple(value or ())
            values[key] = value
    if not values.get("file_appendable", True) and "maxFileCheckingMillis" not in o:
        values["max_file_checking_millis"] = 5000
    if "ignoreNotUpdatedFileEnabled" in o and str(o["ignoreNotUpdatedFileEnabled"]).lower() != "true":
        values["ignore_not_updated_file_seconds"] = -1
    return Flow(file_pattern=values.pop("file_pattern", ""), destination=values.pop("destination"), **values)


@dataclass(frozen=True)
class Config:
    flows: tuple[Flow, ...]
    options: dict[str, Any] = field(default_factory=dict)


def load(text_or_path: str | Path) -> Config:
    """Configuration of a YAML or JSON file (comments allowed), its http address, or its text. Disabled flows
    are left out, two flows of one id are an error."""
    text, yaml_like = str(text_or_path), False
    if re.match(r"https?://\S+$", text):
        from urllib.request import urlopen

        with urlopen(text, timeout=30) as r:
            yaml_like, text = text.endswith((".yml", ".yaml")), r.read().decode()
    elif isinstance(text_or_path, Path) or "\n" not in text and len(text) < 4096 and Path(text).exists():
        yaml_like = Path(text_or_path).suffix in (".yml", ".yaml")
        text = Path(text_or_path).read_text()
    if yaml_like:
        import yaml

        options = yaml.safe_load(text) or {}
    else:
        options = json.loads(without_comments(text))
    flows = [f for f in map(flow, options.get("flows") or []) if f.enable]
    ids = [f.id for f in flows]
    if twice := {i for i in ids if ids.count(i) > 1}:
        raise ValueError(f"more than one flow of id {sorted(twice)}")
    return Config(tuple(flows), {k: v for k, v in options.items() if k != "flows"})


def without_comments(text: str) -> str:
    """JSON without // and /* */ comments and # lines; what stands in strings stays."""
    return re.sub(r'("(?:\\.|[^"\\])*")|//[^\n]*|/\*.*?\*/|(?m:^\s*#[^\n]*)', lambda m: m[1] or "", text, flags=re.S)
