"""Fill-in-the-middle: texts cut at two token boundaries and put in an order with markers.

Units of a text are runs of ASCII letters and single other code points. The offsets between units
form a :class:`BoundarySet`; two draws from the hash of the document's id choose two of them, which
cut the text into prefix, middle and suffix. Two more draws choose the form: ``plain`` (the text as
it is), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle). The draws hang on the
id alone, so a run that is repeated gives the same rows.

Defined results: a null text is empty, and an empty text is plain with 0 units. A text that holds a
marker is plain, so every output can be turned back. A null id draws as the text ``null``; rows of
one id are each cut by the same draws. An empty table gives an empty table. All other columns are
kept, but for those with the name of a result, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.boundary_set import BoundarySet
from millrace.llm.support import extended, kept_columns, map_arrow, ship, small_batches, text_buffer

RESULTS = "n long, form string, prefix_chars long, middle_chars long, output string"
NAMES = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Markers:
    """Texts that stand before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        """None may hold another, or end as another begins: then each is found where it was put."""
        marks = astuple(self)
        for a in marks:
            for b in marks:
                if a != b and a in b or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))):
                    raise ValueError(f"markers {a!r} and {b!r} overlap")
        if not all(marks) or len(set(marks)) < 3:
            raise ValueError("markers must be three different texts")


def unit_starts(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a unit begins at each byte, whether a code point does) for texts between offsets ``at``."""
    folded = body | 0x20
    letter = (folded >= ord("a")) & (folded <= ord("z"))
    point = (body & 0xC0) != 0x80
    begins = point.copy()
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[at[:-1][at[1:] > at[:-1]]] = True
    return begins, point


def boundaries(begins: np.ndarray) -> BoundarySet:
    """The byte offsets before, between and behind the units of one text."""
    starts = np.flatnonzero(begins)
    return BoundarySet(np.append(starts, len(begins)) if len(begins) else np.zeros(1, np.int64))


def _cut(batches: Iterator[pa.RecordBatch], text_col: str, keep: list[str], markers: Markers, plain_percent: int, spm_percent: int) -> Iterator[pa.RecordBatch]:
    before_prefix, before_suffix, before_middle = marks = [m.encode() for m in astuple(markers)]
    for whole in batches:
        for batch in small_batches(whole, text_col):
            body, at = text_buffer(batch.column(text_col))
            begins, point = unit_starts(body, at)
            rows: list[list] = [[], [], [], [], []]
            for a, b, draw in zip(at[:-1].tolist(), at[1:].tolist(), batch.column("_draw").to_pylist()):
                text = body[a:b].tobytes()
                cuts = boundaries(begins[a:b])
                n = len(cuts) - 1
                h = [int(draw[i : i + 8], 16) for i in (0, 8, 16, 24)]
                if not text or h[2] % 100 >= 100 - plain_percent or any(m in text for m in marks):
                    row = (n, "plain", None, None, text)
                else:
                    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                    p, m = cuts.select(first), cuts.select(last)
                    form = "spm" if h[3] % 100 < spm_percent else "psm"
                    front, back = before_prefix + text[:p], before_suffix + text[m:]
                    output = (back + front if form == "spm" else front + back) + before_middle + text[p:m]
                    row = (n, form, int(np.count_nonzero(point[a : a + p])), int(np.count_nonzero(point[a + p : a + m])), output)
                for column, value in zip(rows, row):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(v, k) for v, k in zip(rows, kinds)] + [pa.array(rows[4], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *columns], names=[*keep, *NAMES])


def transform(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
    markers: Markers = Markers(), plain_percent: int = 10, spm_percent: int = 20, seed: int = 1,
) -> DataFrame:
    """``df`` with units ``n``, ``form``, code points of prefix and middle (null if plain) and the ``output``.

    ``plain_percent`` of the texts stay as they are; ``spm_percent`` of the others are ``spm``.
    """
    ship(df.sparkSession)
    keep = kept_columns(df, keep, [*NAMES, "_draw"])
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("_draw")
    needed = df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text_col])], draw)
    schema = extended(df.select(*[f"`{c}`" for c in keep]).schema, RESULTS)
    work = partial(_cut, text_col=text_col, keep=keep, markers=markers, plain_percent=plain_percent, spm_percent=spm_percent)
    return map_arrow(needed, work, schema)


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that :func:`transform` cut, from its output and form."""

    def between(text: Column, opening: str, closing: str) -> Column:
        """What stands between two markers."""
        return F.substring_index(F.substring(text, F.locate(opening, text) + len(opening), F.length(text)), closing, 1)

    middle = F.substring(output, F.locate(markers.middle, output) + len(markers.middle), F.length(output))
    psm = F.concat(between(output, markers.prefix, markers.suffix), middle, between(output, markers.suffix, markers.middle))
    spm = F.concat(between(output, markers.prefix, markers.middle), middle, between(output, markers.suffix, markers.prefix))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
