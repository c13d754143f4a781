"""Fill-in-middle transformation: texts cut at two unit boundaries and put in another order.

A unit is a run of letters A-Z, a-z, or any other code point. A text is fixed blocks of UTF-8 bytes; a
Fenwick tree over the blocks holds how many units start and how many code points lie in each. A cut
after k units descends the tree by binary lifting to the block where unit k starts, and is then located
in that block alone. Cuts are byte offsets, so texts are never decoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
#: Marks before prefix, suffix and middle; a text that holds one stays plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_P, _S, _M = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: UTF-8 bytes that go on with a code point.
_INSIDE = np.zeros(256, bool)
_INSIDE[0x80:0xC0] = True


class Blocks:
    """A text's blocks in a Fenwick tree of (units that start, code points)."""

    def __init__(self, text: bytes, block: int = BLOCK):
        raw = np.frombuffer(text, np.uint8)
        letter = _LETTER[raw]
        self.size, self.block = len(raw), block
        self.points = ~_INSIDE[raw]
        self.starts = self.points.copy()
        self.starts[1:] &= ~(letter[1:] & letter[:-1])
        firsts = np.arange(0, self.size, block)
        counts = [np.add.reduceat(x, firsts, dtype=np.int64) if self.size else firsts for x in (self.starts, self.points)]
        sums = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
        at = np.arange(len(firsts) + 1)
        # node i covers the blocks after i without its lowest set bit, up to i
        self.units, self.chars = ((s - s[at & (at - 1)]).tolist() for s in sums)
        self.n = int(sums[0][-1])

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) where unit k starts; the text's end for k = n."""
        units, chars, last = self.units, self.chars, len(self.units) - 1
        at, left, before = 0, k, 0
        step = 1 << last.bit_length() >> 1
        while step:
            if at + step <= last and units[at + step] <= left:
                at += step
                left -= units[at]
                before += chars[at]
            step >>= 1
        if at == last:
            return self.size, before
        begin = at * self.block
        inner = int(np.flatnonzero(self.starts[begin : begin + self.block])[left])
        return begin + inner, before + int(np.count_nonzero(self.points[begin : begin + inner]))


def arranged(text: bytes, form: str, a: int, b: int) -> bytes:
    """The text, cut at bytes a and b, in ``form``."""
    if form == "plain":
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    return b"".join((_P, prefix, _S, suffix, _M, middle) if form == "psm" else (_S, suffix, _P, prefix, _M, middle))


def rebuilt(output: bytes, form: str) -> bytes:
    """arranged() backwards, from output and form alone: no part holds a mark, and marks don't overlap each other."""
    if form == "plain":
        return output
    second = output.index(_S if form == "psm" else _P)
    third = output.index(_M, second)
    one, two, middle = output[3:second], output[second + 3 : third], output[third + 3 :]
    return one + middle + two if form == "psm" else two + middle + one


def draws(seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first digits of the SHA-256 of ``seed:doc_id`` (null id: nothing after the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, keep_text: bool = False, block: int = BLOCK) -> DataFrame:
    """Documents -> doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 and, with ``keep_text``, output.

    ``rate`` percent of the texts are cut, of these ``spm`` percent as suffix, prefix, middle (spm), the
    others as prefix, suffix, middle (psm). Empty texts, and texts with a mark, are plain; null text is
    empty. Draws follow from doc_id alone: rows of one id and text give equal rows, and rows without id
    share their draws. Columns besides doc_id and text are ignored, whatever their names. A document is
    handled alone, in memory that follows its length.
    """
    text = F.coalesce("text", F.lit(""))
    h1, h2, h3, h4 = draws(seed)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string" + ", output string" * keep_text

    def one(text: bytes, form: str, h1: int, h2: int) -> tuple:
        blocks = Blocks(text, block)
        a = b = prefix = middle = None
        if form != "plain":
            first, second = sorted((h1 % (blocks.n + 1), h2 % (blocks.n + 1)))
            (a, prefix), (b, upto) = blocks.cut(first), blocks.cut(second)
            middle = upto - prefix
        output = arranged(text, form, a, b)
        found = blocks.n, prefix, middle, hashlib.sha256(output).hexdigest(), hashlib.sha256(rebuilt(output, form)).hexdigest()
        return (*found, output.decode()) if keep_text else found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        names = ["n", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "output"]
        for batch in batches:
            rows = [one(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("text", "form", "h1", "h2")), strict=True)]
            made = zip(*rows, strict=True) if rows else [[]] * (5 + keep_text)
            columns = {k: pa.array(v, t) for k, v, t in zip(names, made, kinds, strict=False)}
            columns |= {"doc_id": batch.column("doc_id"), "form": batch.column("form")}
            yield pa.RecordBatch.from_pydict({c.split()[0]: columns[c.split()[0]] for c in schema.split(", ")})

    return rows.mapInArrow(work, schema)
