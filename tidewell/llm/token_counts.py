"""Token counts of sections by offset-mapped attribution: a document is encoded once, and its tokens are joined to sections by their spans.

A byte-level token's span is known from its bytes, as tokens follow each other without gaps. Sections are half-open byte spans, here
lines with the line feed that ends them, or named fields of a row joined by a separator. A token inside one section counts there. One that
crosses a boundary is allocated by ``rule``: ``start``, to the section of its first byte; ``largest``, to the section with most of its
bytes, the first at a tie; ``share``, to each section the part of its bytes. Every rule gives a document's sections, separators
included in the section they end, exactly the document's number of tokens.

A null text has no sections; an empty text has one, empty, line. Null fields count as empty. Repeated rows are counted each. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.encode import batches, encoder

SCHEMA = "doc_id long, section long, start long, length long, tokens double, crossing long"


def allocate(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) per section. Both lists of ends are ascending and end at the same byte."""
    starts = np.concatenate(([0], token_ends[:-1]))
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, token_ends - 1, side="right")
    crossing = np.flatnonzero(last > first)
    n = len(section_ends)
    crosses = np.bincount(first[crossing], minlength=n)
    if rule == "start":
        return np.bincount(first, minlength=n).astype(np.float64), crosses
    counts = np.bincount(first[last == first], minlength=n).astype(np.float64)
    begins = np.concatenate(([0], section_ends[:-1]))
    for t in crossing.tolist():
        own = np.arange(first[t], last[t] + 1)
        part = np.minimum(section_ends[own], token_ends[t]) - np.maximum(begins[own], starts[t])
        if rule == "largest":
            counts[own[int(np.argmax(part))]] += 1
        else:
            counts[own] += part / part.sum()
    return counts, crosses


def _counted(rows: DataFrame, vocabulary: str, rule: str) -> DataFrame:
    """Of (doc_id, text, ends): ends are the sections' last bytes, or null for lines."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        bytes_of = code.byte_lengths()
        for part in parts:
            ids, given = part.column(0), part.column(2)
            at = 0
            for texts in batches(x.as_py() for x in part.column(1)):
                tokens, bounds = code.encode(texts)
                out: list[list[np.ndarray]] = []
                for k, text in enumerate(texts):
                    raw = np.frombuffer(text.encode(), dtype=np.uint8)
                    ends = given[at + k].as_py()
                    ends = np.array(ends, dtype=np.int64) if ends is not None else np.append(np.flatnonzero(raw == 10) + 1, len(raw))
                    token_ends = np.cumsum(bytes_of[tokens[bounds[k] : bounds[k + 1]]])
                    counts, crosses = allocate(token_ends, ends, rule) if len(token_ends) else (np.zeros(len(ends)), np.zeros(len(ends), np.int64))
                    begins = np.concatenate(([0], ends[:-1]))
                    out.append([np.full(len(ends), at + k), np.arange(len(ends)), begins, ends - begins, counts, crosses])
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                at += len(texts)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(columns[0])), *(pa.array(c) for c in columns[1:])], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)


def line_token_counts(documents: DataFrame, vocabulary: str, rule: str = "start", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per line of each text: doc_id, section (from 0), first byte, length in bytes, tokens, crossing tokens that begin there."""
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), F.lit(None).cast("array<long>").alias("ends"))
    return _counted(rows.filter("text is not null"), vocabulary, rule)


def field_token_counts(rows: DataFrame, fields: list[str], vocabulary: str, rule: str = "start", id_column: str = "doc_id", separator: str = "\n") -> DataFrame:
    """Per row and field, in the order of ``fields``: the same columns. A field's section ends with the separator after it."""
    texts: list[Column] = [F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields]
    lengths = [F.octet_length(t) + (len(separator.encode()) if k < len(fields) - 1 else 0) for k, t in enumerate(texts)]
    ends = F.array(*[sum(lengths[1 : k + 1], lengths[0]).cast("long") for k in range(len(fields))])
    return _counted(rows.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.concat_ws(separator, *texts).alias("text"), ends.alias("ends")), vocabulary, rule)
