"""Fill-in-middle: texts rearranged so that a model learns to write a missing middle.

A batch of texts is one pipeline of ``pyarrow.compute`` calls, without a loop over texts. Texts are split into list
arrays of lines and flattened with their parents' numbers; a line's ordinal is its flat place less that of its text's
first line. Two hashed cut points deal the ordinals to three roles (prefix, middle, suffix). The lines of each role are
filtered, built into lists again and joined, and the pieces are joined with the marks ``<P>``, ``<S>`` and ``<M>``:
prefix first (``psm``) or suffix first (``spm``). ``restored`` takes an output apart again.

A line is ``[^\\n]*\\n`` or a last ``[^\\n]+``. Hashes come from the key alone, so reruns and other partitions agree.
One pass, no shuffle; a task holds about a megabyte of text at a time, or one text if that is longer.

Defined results: a null text is an empty one; an empty text, one that holds a mark, and one that the rate leaves out are
``plain``: their output is the text. A null key is hashed as an empty one; equal rows give equal rows; cuts may fall
together, so each piece may be empty; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.common import slices

MARKS = ("<P>", "<S>", "<M>")
_BATCH = 1 << 20
_SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"


def _remainder(value: pa.Array, by: pa.Array | int) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def _first(lists: pa.Array, sizes: pa.Array) -> pa.Array:
    """The flat place of the first element of each list, once for each element."""
    begins = pc.subtract(pc.cumulative_sum(sizes), sizes)
    return begins.take(pc.list_parent_indices(lists))


def lines_of(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """All lines with their ends, the text each belongs to, and the number of lines of each text."""
    parts = pc.split_pattern(texts, "\n")
    sizes = pc.list_value_length(parts).cast(pa.int64())
    parent, flat = pc.list_parent_indices(parts), pc.list_flatten(parts)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), _first(parts, sizes))
    last = pc.equal(ordinal, pc.subtract(sizes, 1).take(parent))
    lines = pc.binary_join_element_wise(flat, pc.if_else(last, "", "\n"), "")
    there = pc.greater(pc.binary_length(lines), 0)  # behind the last line break, or in an empty text, there is no line
    parent = parent.filter(there).cast(pa.int64())
    counts = np.bincount(parent.to_numpy(), minlength=len(texts))
    return lines.filter(there), parent, pa.array(counts, pa.int64())


def _joined(lines: pa.Array, parent: pa.Array, role: pa.Array, texts: int) -> pa.Array:
    """The lines that have the role, put together again text by text."""
    chosen, owner = lines.filter(role), parent.filter(role).to_numpy()
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), chosen), "")


def transformed(texts: pa.Array, hashes: list[pa.Array], rate: int, spm: int, marks: tuple[str, str, str]) -> list[pa.Array]:
    """Numbers of lines, forms, characters of prefix and middle, outputs. ``hashes``: four whole numbers for each text."""
    lines, parent, n = lines_of(texts)
    one, two = (_remainder(h, pc.add(n, 1)) for h in hashes[:2])
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    begins = pc.subtract(pc.cumulative_sum(n), n).take(parent)
    ordinal = pc.subtract(pa.array(np.arange(len(lines))), begins)
    before, inside = pc.less(ordinal, low.take(parent)), pc.less(ordinal, high.take(parent))
    prefix = _joined(lines, parent, before, len(texts))
    middle = _joined(lines, parent, pc.and_not(inside, before), len(texts))
    suffix = _joined(lines, parent, pc.invert(inside), len(texts))
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_remainder(hashes[2], 100), rate))
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    back = pc.less(_remainder(hashes[3], 100), spm)
    form = pc.if_else(plain, "plain", pc.if_else(back, "spm", "psm"))
    p, s, m = (pa.scalar(x, pa.string()) for x in marks)
    none = pa.scalar("", pa.string())
    output = pc.if_else(plain, texts, pc.if_else(
        back, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)))
    unknown = pa.scalar(None, pa.int64())
    return [n, form, *(pc.if_else(plain, unknown, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)), output]


def taken_apart(outputs: pa.Array, forms: pa.Array, marks: tuple[str, str, str]) -> pa.Array:
    """The texts that outputs and forms were made from. No text but a plain one holds a mark, so the first is the one."""
    p, s, m = marks
    at = lambda lists, i: pc.list_element(lists, i)
    texts = [None] * 3
    for k, (form, second) in enumerate((("psm", s), ("spm", p))):
        rows = outputs.filter(pc.equal(forms, form))
        one = pc.split_pattern(rows, second, max_splits=1)
        two = pc.split_pattern(at(one, 1), m, max_splits=1)
        first = pc.binary_replace_slice(at(one, 0), 0, len((p, s)[k]), "")
        prefix, suffix = (first, at(two, 0)) if form == "psm" else (at(two, 0), first)
        texts[k] = pc.binary_join_element_wise(prefix, at(two, 1), suffix, "")
    texts[2] = outputs.filter(pc.equal(forms, "plain"))
    places = [pc.indices_nonzero(pc.equal(forms, f)) for f in ("psm", "spm", "plain")]
    return pa.concat_arrays(texts).take(pc.sort_indices(pa.concat_arrays(places)))


def _transforming(rate: int, spm: int, marks: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, _BATCH):
                texts = part.column(1).cast(pa.string()).fill_null("")
                made = transformed(texts, [part.column(i) for i in range(2, 6)], rate, spm, marks)
                yield pa.RecordBatch.from_arrays([part.column(0), *made], ["doc_id", "n", "form", "prefix_chars",
                                                                           "middle_chars", "output"])
    return run


def _restoring(marks: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("output")
            for part in slices(batch, at, _BATCH):
                texts = taken_apart(part.column(at).cast(pa.string()), part.column("form").cast(pa.string()), marks)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "restored"])
    return run


def fill_in_middle(docs: DataFrame, rate: int = 100, spm: int = 50, seed: int = 7, marks: tuple[str, str, str] = MARKS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row.

    ``rate`` is the share of texts rearranged and ``spm`` the share of those with the suffix first, both of 100.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *numbers) \
        .mapInArrow(_transforming(rate, spm, marks), f"doc_id {kind}, {_SCHEMA}")


def restored(made: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The rows of ``fill_in_middle`` with the text that each output was made from, as ``restored``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema)
    return made.mapInArrow(_restoring(marks), f"{fields}, restored string")
