"""Fill-in-middle: texts cut at token boundaries and put into another order by rotating blocks in place.

A text is ``prefix middle suffix``. With sentinels in front of each segment it is one buffer, ``<P>prefix<M>middle
<S>suffix``, and both orders are one rotation of it: ``psm`` exchanges the last two segments, ``spm`` moves the last one
to the front. A rotation reverses both blocks and then the whole, so it needs no second buffer, and the same rotation
with the lengths exchanged undoes it. Sentinels can't be confused with texts: texts that contain one stay plain, and as
``<`` only begins and ``>`` only ends a sentinel, none can arise where a segment meets one.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.textblocks import blocks, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Of 100 texts so many are transformed, and of 100 transformed ones so many get the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
_MARK = re.compile(b"<[PSM]>")
_MADE = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


def rotate(buffer: np.ndarray, start: int, middle: int, end: int) -> None:
    """Exchange ``buffer[start:middle]`` and ``buffer[middle:end]`` in place by three reversals."""
    for a, b in ((start, middle), (middle, end), (start, end)):
        buffer[a:b] = buffer[a:b][::-1].copy()


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with sentinels, cut behind so many bytes, in the order of ``form``."""
    out = bytearray(text)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):  # from behind: cuts before stay where they are
        out[at:at] = mark
    view = np.frombuffer(out, np.uint8)
    rotate(view, first + 3 if form == "psm" else 0, second + 6, len(out))
    return out


def rearrange(output: bytes, form: str) -> bytearray:
    """The inverse of ``arrange``: rotate back, then take the sentinels out."""
    out = bytearray(output)
    if form == "plain":
        return out
    at = {m.group(): m.start() for m in _MARK.finditer(output)}
    view = np.frombuffer(out, np.uint8)
    if form == "psm":
        rotate(view, at[SUFFIX], at[MIDDLE], len(out))
    else:
        rotate(view, 0, at[PREFIX], len(out))
    del view  # a buffer with a view on it can't change its length
    for m in reversed(list(_MARK.finditer(bytes(out)))):
        del out[m.start():m.end()]
    return out


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the units of a block begin: runs of the letters A-Z and a-z, and every other character."""
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    inside = offsets[:-1][np.diff(offsets) > 0]
    begins[inside] = True
    return np.flatnonzero(begins)


def _choose(draws: list[np.ndarray], n: np.ndarray, can: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Form and both cuts, in units, of each text."""
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    form = np.where(draws[3] % 100 < SUFFIX_FIRST, "spm", "psm")
    form = np.where(~can | (draws[2] % 100 >= TRANSFORMED), "plain", form)
    return form, np.minimum(one, two), np.maximum(one, two)


def _transform_block(text: pa.Array, draws: list[np.ndarray]) -> pa.Array:
    data, offsets = texts_of(text)
    body = data.tobytes()
    starts = unit_starts(data, offsets)
    first_unit = np.searchsorted(starts, offsets)
    n = np.diff(first_unit)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    marked = np.zeros(len(n), bool)
    for m in _MARK.finditer(body):
        # A mark that lies across two texts is none.
        doc = np.searchsorted(offsets, m.start(), "right") - 1
        marked[doc] |= m.end() <= offsets[doc + 1]
    form, one, two = _choose(draws, n, (n > 0) & ~marked)
    ends = np.append(starts, len(data))
    # A cut behind all units of a text is its end, which is where the next text's first unit begins.
    a, b = ends[first_unit[:-1] + one], ends[first_unit[:-1] + two]
    out = [body[lo:hi] if f == "plain" else bytes(arrange(body[lo:hi], x - lo, y - lo, f))
           for f, lo, hi, x, y in zip(form.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), a.tolist(), b.tolist())]
    plain = form == "plain"
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
         pa.array(chars[a] - chars[offsets[:-1]], pa.int64(), mask=plain),
         pa.array(chars[b] - chars[a], pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
        ["n", "form", "prefix_chars", "middle_chars", "output"])


def draws_of(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2**32 for a document: the first digits of the hash of seed and id. A NULL id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """All rows and columns plus ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Cuts, form and whether a text is transformed at all depend on its id and ``seed`` alone, so a repeated id with
    another text is drawn alike, and a job that runs again gives the same rows. NULL texts are empty; empty texts and
    texts with a sentinel in them stay ``plain``, with NULL lengths. Columns of these names are replaced. Whole texts
    are rotated, each in a buffer of its own; a text is bounded by what a row may hold.
    """

    def made(text: pa.Array, *draws: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, *draws], ["text", "h1", "h2", "h3", "h4"])
        parts = [_transform_block(p.column(0), [p.column(k + 1).to_numpy() for k in range(4)])
                 for p in blocks(batch, "text")]
        return pa.chunked_array(parts, pa.struct([
            ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
            ("output", pa.string())])).combine_chunks()

    made.__annotations__ = {"text": pa.Array, "draws": pa.Array, "return": pa.Array}
    run = F.arrow_udf(made, _MADE).asNondeterministic()
    out = docs.withColumn("_made", run(F.col(text_col).cast("string"), *draws_of(id_col, seed)))
    return out.withColumns({c: F.col(f"_made.{c}") for c in ("n", "form", "prefix_chars", "middle_chars", "output")}).drop("_made")


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form", out_col: str = "restored") -> DataFrame:
    """All rows plus ``out_col``: the exact text, from output and form alone. NULL outputs give NULL; a NULL form is plain."""

    def undo(output: pa.Array, form: pa.Array) -> pa.Array:
        texts = [None if t is None else bytes(rearrange(t, f or "plain"))
                 for t, f in zip(output.cast(pa.binary()).to_pylist(), form.to_pylist())]
        return pa.array(texts, pa.binary()).cast(pa.string())

    undo.__annotations__ = {"output": pa.Array, "form": pa.Array, "return": pa.Array}
    return rows.withColumn(out_col, F.arrow_udf(undo, "string").asNondeterministic()(F.col(output_col), F.col(form_col)))
