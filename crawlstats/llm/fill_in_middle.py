"""Fill-in-the-middle: texts cut into prefix, middle and suffix at two unit ranks.

The units of a text are its lines (a line feed ends one and belongs to it). An
indexable skip list stands over them: its lowest lane has a link for each
unit, every ``SPREAD``-th node rises to the lane above, and a link of any lane
carries the units and the code points that it spans. To find a cut rank the
search starts in the top lane, follows links while the units passed stay
within the rank, and drops a lane otherwise; the widths add up to the rank
itself and to its place in code points.

The cuts and the form of a text follow from the SHA-256 of ``seed:id``, so a
repeated run, or a task that is run again, gives the same output.

Defined cases: a null text is empty, an empty text and one that holds a
sentinel stay as they are (form ``plain``); a null id is hashed as no digits;
repeated rows are cut alike, each on its own; equal cut ranks give an empty
middle; very long texts are cut as others are, one text at a time; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.common import documents, map_batches

#: Nodes of a lane for each node of the lane above.
SPREAD = 4
#: Sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
FIELDS = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]


def lines(text: str) -> list[str]:
    """The units of a text: lines with the line feeds that end them."""
    parts = text.split("\n")
    units = [p + "\n" for p in parts[:-1]]
    return units + parts[-1:] if parts[-1] else units


class SkipList:
    """Units in order, with lanes of links that carry how many units and code points they span."""

    def __init__(self, widths: Sequence[int]):
        units, points = [1] * len(widths), list(widths)
        self.lanes = [(units, points)]
        while len(units) > SPREAD:
            starts = range(0, len(units), SPREAD)
            units, points = [sum(units[i : i + SPREAD]) for i in starts], [sum(points[i : i + SPREAD]) for i in starts]
            self.lanes.append((units, points))

    def __len__(self) -> int:
        return sum(self.lanes[-1][0])

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank (after the last one, for the number of units)."""
        passed = points = node = 0
        for units, widths in reversed(self.lanes):
            node *= SPREAD  # the same node, a lane below
            while node < len(units) and passed + units[node] <= rank:
                passed += units[node]
                points += widths[node]
                node += 1
        return points


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def transform(text: str, draw: Sequence[int], rate: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix and middle in code points, output) of one text."""
    index = SkipList([len(u) for u in lines(text)])
    n = len(index)
    if not text or any(s in text for s in SENTINELS) or draw[2] % 100 >= rate:
        return n, "plain", None, None, text
    first, second = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
    a, b = index.place(first), index.place(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = SENTINELS
    if draw[3] % 100 < spm:
        return n, "spm", a, b - a, s + suffix + p + prefix + m + middle
    return n, "psm", a, b - a, p + prefix + s + suffix + m + middle


def fill_in_middle(docs: DataFrame, *, seed: int = 7, rate: int = 100, spm: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    ``rate`` percent of the documents are cut, ``spm`` percent of these give
    their suffix first.
    """

    def cut(batches):
        for b in batches:
            rows = [(d, *transform(t, draws(seed, d), rate, spm)) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            columns = zip(*rows) if rows else [()] * len(FIELDS)
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, FIELDS)]
            yield pa.RecordBatch.from_arrays(arrays, [name for name, _ in FIELDS])

    return map_batches(documents(docs, id_col, text_col), cut, SCHEMA)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from.

    No part holds a sentinel, so splitting at them gives the parts again.
    """
    parts = F.split(F.col(output), "|".join(SENTINELS))
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))  # before the first sentinel is nothing
    psm = F.concat(first, middle, second)
    spm = F.concat(second, middle, first)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
