"""Log formats: anchored patterns, their fields, and which of them may be null."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token grammar of the formats.
INTEGER = r"(?:[+-]?(?:[0-9]+))"
POSITIVE = r"(?:[1-9][0-9]*)"
DIGITS = r"(?:[0-9]+)"
HOST = r"(?:(?:[\w\-]+)(?:\.(?:[\w\-]+))*(?:\.?|\b)|(?:[\d\.]+))"
USER = r"(?:[a-zA-Z0-9._-]+)"
QUOTED = r'[^"]+'
MONTH_DAY = r"(?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])"
WEEKDAY = r"(?:Mon(?:day)?|Tue(?:sday)?|Wed(?:nesday)?|Thu(?:rsday)?|Fri(?:day)?|Sat(?:urday)?|Sun(?:day)?)"
MONTH = r"\b(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\b"
YEAR = r"(?:[1-9]\d*)"
CLOCK = r"(?:(?:2[0123]|[01]?[0-9]):(?:[0-5][0-9]):(?:(?:[0-5]?[0-9]|60)(?:[:\.,][0-9]+)?))"
RFC3339 = r"(?:\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?)(?:Z|(?:[-+]\d{2}:\d{2}))"
PROGRAM = r"([\w\._/%-]+)(?:\[((?:[1-9][0-9]*))\])?"
FACILITY = r"(?:<(?:[0-9]+).(?:[0-9]+)> )?"

# The whole patterns of the formats.
ACCESS = rf'({HOST}) ({USER}) ({USER}) \[({MONTH_DAY}/{MONTH}/{YEAR}:{CLOCK}\s{INTEGER})\] "({QUOTED})" ({INTEGER}|\-) ({INTEGER}|\-)'
ERROR = rf"\[({WEEKDAY}\s+{MONTH}\s+{MONTH_DAY}\s+{CLOCK}\s+{YEAR})\] \[(?:(\w+):)?(\w+)\] \[pid ({DIGITS})(?::tid ({DIGITS}))?\] \[client ({HOST}(?::{POSITIVE})?)\] (.*)"
SYSLOG = rf"({MONTH}\s+{MONTH_DAY}\s+{CLOCK}) {FACILITY}({USER}) {PROGRAM}: (.*)"
SYSLOG_3339 = rf"({RFC3339}) {FACILITY}({USER}) {PROGRAM}: (.*)"


@dataclass(frozen=True)
class LogFormat:
    name: str
    pattern: str
    fields: tuple[str, ...]
    #: Fields whose group may be absent: an empty value of theirs is null.
    optional: frozenset[str] = field(default_factory=frozenset)
    dash_is_null: bool = False

    def __post_init__(self) -> None:
        import re

        if len(set(self.fields)) != len(self.fields):
            raise ValueError(f"field names must differ: {self.fields}")
        if (n := re.compile(self.pattern).groups) != len(self.fields):
            raise ValueError(f"the pattern has {n} groups for {len(self.fields)} fields")

    def renamed(self, fields: list[str] | tuple[str, ...]) -> LogFormat:
        """The format with other field names, as many as it has."""
        if len(fields) != len(self.fields):
            raise ValueError(f"{self.name} has {len(self.fields)} fields, not {len(fields)}")
        new = dict(zip(self.fields, fields, strict=True))
        return LogFormat(self.name, self.pattern, tuple(fields), frozenset(new[f] for f in self.optional), self.dash_is_null)


ACCESS_FIELDS = ("host", "ident", "authuser", "datetime", "request", "response", "bytes")
SYSLOG_FIELDS = ("timestamp", "hostname", "program", "processid", "message")
FORMATS = {
    f.name: f
    for f in (
        LogFormat("COMMONAPACHELOG", ACCESS + ".*", ACCESS_FIELDS, dash_is_null=True),
        LogFormat("COMBINEDAPACHELOG", rf'{ACCESS} "({QUOTED})" "({QUOTED})".*', (*ACCESS_FIELDS, "referer", "agent"), dash_is_null=True),
        LogFormat("APACHEERRORLOG", ERROR, ("timestamp", "module", "severity", "processid", "threadid", "client", "message"), frozenset({"module", "threadid"}), dash_is_null=True),
        LogFormat("SYSLOG", SYSLOG, SYSLOG_FIELDS, frozenset({"processid"})),
        LogFormat("RFC3339SYSLOG", SYSLOG_3339, SYSLOG_FIELDS, frozenset({"processid"})),
    )
}


def log_format(name: str | None, fields: list[str] | None = None, pattern: str | None = None) -> LogFormat:
    """A built-in format, with its own or given field names, or one of a given pattern. The
    dash rule of the Apache family holds for a given pattern too, if it names such a format."""
    if pattern is not None:
        if not fields:
            raise ValueError("a pattern needs field names")
        family = name is not None and name.upper() in ("COMMONAPACHELOG", "COMBINEDAPACHELOG", "APACHEERRORLOG")
        return LogFormat(name or "CUSTOM", pattern, tuple(fields), frozenset(fields), family)
    if name is None or name.upper() not in FORMATS:
        raise ValueError(f"unknown log format {name}; known: {sorted(FORMATS)}")
    out = FORMATS[name.upper()]
    return out.renamed(fields) if fields else out


SEPARATOR = "\x01"


def parse(line: Column, fmt: LogFormat) -> Column:
    """A struct of the format's fields, all strings, or null where the whole line doesn't match.

    One pass of the pattern gives all groups, joined by a control character and split again;
    only lines that hold that character themselves are matched once a field.
    """
    anchored = rf"^(?:{fmt.pattern})\z"
    joined = F.regexp_replace(line, anchored, SEPARATOR + SEPARATOR.join(f"${i + 1}" for i in range(len(fmt.fields))))
    once_a_field = F.array(F.lit(""), *[F.regexp_extract(line, anchored, i + 1) for i in range(len(fmt.fields))])
    groups = F.when(~F.contains(line, F.lit(SEPARATOR)), F.split(joined, SEPARATOR, -1)).when(line.rlike(anchored), once_a_field)

    def value(groups: Column, i: int, name: str) -> Column:
        v = F.get(groups, F.lit(i + 1))
        v = F.nullif(v, F.lit("")) if name in fmt.optional else v
        return (F.nullif(v, F.lit("-")) if fmt.dash_is_null else v).alias(name)

    # a lambda over one element, so that the groups are found once and not once a field
    fields = F.transform(F.array(groups), lambda g: F.when(F.size(g) == len(fmt.fields) + 1, F.struct(*[value(g, i, n) for i, n in enumerate(fmt.fields)])))
    return F.get(fields, F.lit(0))
