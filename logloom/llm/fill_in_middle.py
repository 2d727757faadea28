"""Fill-in-the-middle: a document's lines are cut at two ranks and laid out as prefix, suffix and middle.

The lines of a text (with their line feeds) are the units of an indexable skip list. Each lane of the list skips
``FANOUT`` nodes of the lane below, and every node carries its width in units and in code points. Descending
by accumulated widths reaches a unit's rank in a few steps for each lane and gives the code point there, so both cuts
are exact and the text is never looked at again. The lanes above the lowest take a fifteenth of its room.

The two ranks, whether a document is changed at all, and the layout come from a hash of the salt and the id, so
a lost task's rerun gives the same rows. Nothing is shuffled; a text is held once with its output.

A null text is an empty one. An empty text, and one that contains a mark, stays as it is (form ``plain``). A null id
is hashed as an empty string. Repeated rows give repeated rows. An empty table gives no rows. Other columns are not
looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SALT = 7
PERCENT = 100  #: of the documents that are changed
SPM_PERCENT = 50  #: of the changed ones that begin with the suffix
FANOUT = 16
#: Characters of output rows handed on together.
FLUSH_CHARS = 4 << 20


class SkipList:
    """Units in order, with express lanes; ``widths`` are the units' code points."""

    def __init__(self, widths: np.ndarray, fanout: int = FANOUT):
        self.fanout, self.n = fanout, len(widths)
        self.lanes = [(np.ones(len(widths), dtype=np.int64), widths)]
        while len(self.lanes[-1][0]) > fanout:
            units, chars = self.lanes[-1]
            heads = np.arange(0, len(units), fanout)
            self.lanes.append((np.add.reduceat(units, heads), np.add.reduceat(chars, heads)))

    def code_points(self, rank: int) -> int:
        """Code points before the unit of this rank; the whole text's for ``rank`` = n."""
        node = units = chars = 0
        for lane_units, lane_chars in reversed(self.lanes):
            while node < len(lane_units) and units + lane_units[node] <= rank:
                units += int(lane_units[node])
                chars += int(lane_chars[node])
                node += 1
            node *= self.fanout
        return chars


def line_widths(text: str) -> np.ndarray:
    """Code points of each line with its line feed; the rest after the last line feed is a line if there is any."""
    parts = text.split("\n")
    widths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1
    widths[-1] -= 1
    return widths if widths[-1] else widths[:-1]


@dataclass(frozen=True)
class Draw:
    """What the hash of a document's id decides."""

    first: int
    second: int
    change: int
    layout: int

    @classmethod
    def of(cls, doc_id: object, salt: int) -> Draw:
        digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return cls(*(int(digest[i : i + 8], 16) for i in range(0, 32, 8)))


def transform(text: str, draw: Draw, percent: int = PERCENT, spm_percent: int = SPM_PERCENT) -> tuple[int, str, int | None, int | None, str]:
    """(lines, form, code points of the prefix, of the middle, output) of one text."""
    widths = line_widths(text)
    n = len(widths)
    if not text or draw.change % 100 >= percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    units = SkipList(widths)
    a, b = sorted(units.code_points(h % (n + 1)) for h in (draw.first, draw.second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draw.layout % 100 < spm_percent:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(documents: DataFrame, salt: int = SALT, percent: int = PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): a row per document, with the text to train on."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            id_kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id = doc_id.as_py()
                rows.append((doc_id, *transform(text.as_py() or "", Draw.of(doc_id, salt), percent, spm_percent)))
                size += len(rows[-1][-1])
                if size >= FLUSH_CHARS:
                    yield _batch(rows, id_kind)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, id_kind)

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(transformed, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def _batch(rows: list[tuple], id_kind: pa.DataType) -> pa.RecordBatch:
    kinds = [id_kind, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def restored(output: Column, form: Column) -> Column:
    """The text before the change, from the output and its form alone.

    A changed text has no mark of its own, and no mark begins with the end of another, so the first place of a mark in
    the output is where it was put.
    """

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substr(output, F.lit(len(start) + 1)), end, 1)

    def after(mark: str) -> Column:
        return F.substring_index(output, mark, -1)

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), F.substring_index(after(SUFFIX), MIDDLE, 1))
    spm = F.concat(F.substring_index(after(PREFIX), MIDDLE, 1), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
