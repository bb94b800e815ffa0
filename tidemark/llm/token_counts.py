"""Token counts of fields and sections from one encoding of the whole document.

A document is encoded once; each token's bytes, and so its characters, follow from the
lengths of the tokens before it. Token spans are joined to section spans in order, and a
token that crosses a boundary is given away by an explicit rule:

- ``first``: to the section of its first character;
- ``largest``: to the section it has most characters in, the earlier one if equal;
- ``share``: to each in proportion to its characters there.

Tokens of characters that no section has count as section -1, so the counts of a
document add up to its tokens. A document is one row's work in an Arrow batch: nothing
is shuffled or exploded.

Defined cases: a null or empty text has no tokens and one section, -1, with none; rows
that repeat get equal results; sections of no length get none; very long texts are
encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidemark.llm.tokens import default_path, encoder

RULES = ("first", "largest", "share")
Sections = Sequence[tuple[int, int]]  # in order and apart, by code points, end exclusive


def line_sections(text: str) -> list[tuple[int, int]]:
    """Lines that are not empty, without their line feeds."""
    found, at = [], 0
    for line in text.split("\n"):
        if line:
            found.append((at, at + len(line)))
        at += len(line) + 1
    return found


def token_spans(text: str, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """First and last character (end exclusive) of each token, two rows; a token that
    holds part of a character's bytes has that character in its span."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    if text.isascii():
        return np.stack([starts, ends])
    raw = np.frombuffer(text.encode(), "uint8")
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return np.stack([character[starts], character[ends - 1] + 1])


def allocate(spans: np.ndarray, sections: Sections, rule: str) -> np.ndarray:
    """Tokens per section, those of no section last."""
    edges = np.array(sections, dtype="int64").reshape(-1, 2)
    n = len(edges)
    out = np.zeros(n + 1)
    starts, ends = spans
    if not n or not len(starts):
        out[n] = len(starts)
        return out
    home = np.searchsorted(edges[:, 0], starts, side="right") - 1
    inside = (home >= 0) & (starts < edges[home, 1])
    whole = inside & (ends <= edges[home, 1])
    if rule == "first":
        np.add.at(out, np.where(inside, home, n), 1)
        return out
    np.add.at(out, home[whole], 1)
    for a, b in zip(starts[~whole], ends[~whole]):  # tokens on a boundary or outside
        lo, hi = np.searchsorted(edges[:, 1], a, side="right"), np.searchsorted(edges[:, 0], b, side="left")
        parts = [(min(b, edges[s, 1]) - max(a, edges[s, 0]), s) for s in range(lo, hi)]
        rest = (b - a) - sum(p for p, _ in parts)
        if rule == "share":
            for p, s in parts:
                out[s] += p / (b - a)
            out[n] += rest / (b - a)
        else:
            best = max(parts, key=lambda p: (p[0], -p[1]), default=(0, n))
            out[best[1] if best[0] and best[0] >= rest else n] += 1
    return out


def attribute(
    docs: DataFrame,
    text: str = "text",
    sections: Callable[[str], Sections] = line_sections,
    rule: str = "largest",
    path: str | None = None,
) -> DataFrame:
    """Other columns of ``docs`` with section, start, end and tokens: one row per section
    of each row's text, section -1 last for what is in none."""
    return _attributed(docs, (text,), lambda parts: (parts[0] or "", sections(parts[0] or "")), rule, path)


def attribute_fields(
    docs: DataFrame, fields: Sequence[str], joint: str = "\n", rule: str = "largest", path: str | None = None
) -> DataFrame:
    """Like ``attribute`` for text columns joined by ``joint`` to one document: section k
    is ``fields[k]``, a null one empty; the joints are in no section."""

    def joined(parts: Sequence[str | None]) -> tuple[str, Sections]:
        found, at = [], 0
        for part in parts:
            found.append((at, at + len(part or "")))
            at += len(part or "") + len(joint)
        return joint.join(p or "" for p in parts), found

    return _attributed(docs, tuple(fields), joined, rule, path)


def _attributed(
    docs: DataFrame,
    texts: tuple[str, ...],
    document: Callable[[Sequence[str | None]], tuple[str, Sections]],
    rule: str,
    path: str | None,
) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = path or default_path()
    made = StructType().add("section", "integer").add("start", "integer").add("end", "integer").add("tokens", "double")
    kept = [c for c in docs.columns if c not in texts and c not in made.names]
    schema = StructType([*(docs.schema[c] for c in kept), *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            row, number, edges, tokens = [], [], [], []
            columns = [batch.column(c).to_pylist() for c in texts]
            for r, parts in enumerate(zip(*columns)):
                content, own = document(parts)
                counts = allocate(token_spans(content, tool.ids(content), tool.lengths), own, rule)
                row += [r] * len(counts)
                number += [*range(len(own)), -1]
                edges += [*own, (0, 0)]
                tokens.append(counts)
            starts, ends = zip(*edges) if edges else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(row, pa.int64())) for c in kept),
                 *(pa.array(x, pa.int32()) for x in (number, starts, ends)),
                 pa.array(np.concatenate(tokens) if tokens else np.zeros(0))],
                names=schema.names,
            )

    return docs.select(*kept, *texts).mapInArrow(run, schema)
