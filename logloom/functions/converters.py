"""Converters: (text, options) -> text, null to drop the record; and chains of them."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.formats import log_format, parse

Converter = Callable[[Column, dict[str, Any]], Column]
REGISTRY: dict[str, Converter] = {}
#: Of converters that can fail: which texts they can't convert.
FAILS: dict[str, Converter] = {}


def register(name: str, fails: Converter | None = None) -> Callable[[Converter], Converter]:
    """Add a converter under an option name; one that can fail says which texts it `fails` on,
    as an error within a column would end the query."""

    def add(f: Converter) -> Converter:
        REGISTRY[name.upper()] = f
        FAILS.pop(name.upper(), None)
        if fails is not None:
            FAILS[name.upper()] = fails
        return f

    return add


def to_json(value: Column, options: dict[str, Any]) -> Column:
    """Compact or pretty JSON in the order of the fields, nulls written out."""
    how = {"ignoreNullFields": "false"}
    kind = str(options.get("jsonFormat", "COMPACT")).upper()
    if kind not in ("COMPACT", "PRETTYPRINT", "PRETTY"):
        raise ValueError(f"unknown jsonFormat {kind}")
    return F.to_json(value, how if kind == "COMPACT" else how | {"pretty": "true"})


def without_break(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\n")), F.substring(text, 1, F.length(text) - 1)).otherwise(text)


def break_of(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\n")), "\n").otherwise("")


@register("SINGLELINE")
def single_line(text: Column, options: dict[str, Any]) -> Column:
    """The text itself."""
    return text


@register("CSVTOJSON")
def csv_to_json(text: Column, options: dict[str, Any]) -> Column:
    """Fields between delimiter characters, each of which separates alone; no quoting. Missing
    fields are null, further ones dropped; an empty line has no field at all."""
    names = list(options.get("customFieldNames") or ())
    if not names:
        raise ValueError("CSVTOJSON needs customFieldNames")
    if len(set(names)) != len(names):
        raise ValueError(f"field names must differ: {names}")
    line = without_break(text)
    chars = "".join(rf"\x{ord(c):02x}" if ord(c) < 256 else c for c in options.get("delimiter", ","))
    parts = F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, f"[{chars}]", -1))
    fields = F.get(F.transform(F.array(parts), lambda p: F.struct(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(names)])), F.lit(0))
    return F.when(text.isNotNull(), F.concat(to_json(fields, options), break_of(text)))


@register("LOGTOJSON")
def log_to_json(text: Column, options: dict[str, Any]) -> Column:
    """The fields of a log line; a line that doesn't match is dropped."""
    fmt = log_format(options.get("logFormat"), options.get("customFieldNames"), options.get("matchPattern"))
    fields = parse(without_break(text), fmt)
    # to_json of null is null, and so is its concatenation
    return F.concat(to_json(fields, options), break_of(text))


def literal(value: Any) -> Column:
    """A JSON-like value as a column."""
    if isinstance(value, dict):
        return F.struct(*[literal(v).alias(str(k)) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        kinds = {type(v) for v in value}
        if len(kinds) > 1 or kinds & {dict, list}:
            return F.parse_json(F.lit(json.dumps(value)))
        return F.array(*[literal(v) for v in value])
    return F.lit(value)


@register("ADDMETADATA")
def add_metadata(text: Column, options: dict[str, Any]) -> Column:
    """An envelope of constant metadata and the text as `data`."""
    if "metadata" not in options:
        raise ValueError("ADDMETADATA needs metadata")
    envelope = F.struct(literal(options["metadata"]).alias("metadata"), without_break(text).alias("data"))
    return F.when(text.isNotNull(), F.concat(to_json(envelope, options), break_of(text)))


@register("ADDBRACKETS")
def add_brackets(text: Column, options: dict[str, Any]) -> Column:
    """The text between braces, a line break at its end inside them."""
    return F.concat(F.lit("{"), text, F.lit("}"))


def chain(text: Column, options: list[dict[str, Any]]) -> Column:
    """The converters named by `optionName`, from left to right; null stays null."""
    for o in options:
        name = str(o.get("optionName", "")).upper()
        if name not in REGISTRY:
            raise ValueError(f"unknown converter {name!r}; known: {sorted(REGISTRY)}")
        text = REGISTRY[name](text, o)
    return text


def guarded(text: Column, options: list[dict[str, Any]]) -> tuple[Column, Column]:
    """The chain, which ends at the first converter that fails, and whether one did: then the
    text is what went in. A null without failure stays dropped."""
    raw, failed = text, F.lit(False)
    for o in options:
        fails = FAILS.get(str(o.get("optionName", "")).upper())
        if fails is not None:
            failed = failed | F.coalesce(fails(text, o), F.lit(False))
            # a branch of CASE is evaluated only for the rows that reach it
            text = F.when(~failed, chain(text, [o]))
        else:
            text = chain(text, [o])
    return with_fallback(text, failed, raw), failed


def with_fallback(converted: Column, failed: Column, raw: Column) -> Column:
    """The raw text where a conversion failed; a null without failure stays dropped."""
    return F.when(failed, raw).otherwise(converted)


def ascii_only(delimiter: str) -> str:
    """The first character of a record delimiter, which must be ASCII."""
    if not delimiter or not re.match(r"[\x00-\x7f]", delimiter):
        raise ValueError("a record delimiter is an ASCII character")
    return delimiter[0]
