"""Fill-in-middle rows: each text cut into prefix, middle and suffix and laid out for training.

The cuts are counted in units of one code point. They are found on the UTF-8
bytes with whole-word arithmetic (SWAR): the texts of a slice lie one after
the other in one buffer, viewed as 64-bit words. A byte ends a unit when the
byte after it does not continue one (``10xxxxxx``); shifts and masks put a 1
into each such byte of a word, ``bitwise_count`` counts them per word, and the
running sum over words is searched for the word that holds the k-th end. Inside
that word a multiplication gives running counts per byte, and one more
subtraction and count tell the byte.

The three lengths come from a hash of the row's key alone, so the same row
gives the same output in any partition or run.

Defined results: a NULL text is the empty text and an empty text is ``plain``.
A NULL key counts as the empty string in the hash. Repeated rows give repeated,
equal rows. A text that holds one of the marks is ``plain``, so ``restored``
always gives back the exact text. Texts are never cut short, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import arrow_schema, col, map_arrow, slices

LOW = np.uint64(0x0101010101010101)  # a one in every byte
HIGH = np.uint64(0x8080808080808080)  # the top bit of every byte

MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle


def unit_ends(data: np.ndarray) -> np.ndarray:
    """The bytes of UTF-8 texts as 64-bit words with a 1 in each byte that ends a code point, else 0.

    Bytes past the end of ``data`` hold 0.
    """
    n = len(data)
    padded = np.zeros(n // 8 * 8 + 8, dtype=np.uint8)
    padded[:n] = data
    words = padded.view("<u8")
    starts = ~((words >> np.uint64(7)) & ~(words >> np.uint64(6))) & LOW
    after = np.append(starts[1:], LOW)
    ends = (starts >> np.uint64(8)) | (after << np.uint64(56))
    # The padding holds no ends: keep the first n % 8 bytes of the last word.
    ends[-1] &= np.uint64((1 << 8 * (n % 8)) - 1)
    return ends


class Units:
    """Rank and select over the code points of a buffer of UTF-8 texts."""

    def __init__(self, data: np.ndarray) -> None:
        self.ends = unit_ends(data)
        self.upto = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of units that end before the byte offsets ``at``."""
        word, inside = at >> 3, (at & 7).astype(np.uint64)
        mask = (np.uint64(1) << (inside * np.uint64(8))) - np.uint64(1)
        before = np.where(word > 0, self.upto[word - 1], 0)
        return before + np.bitwise_count(self.ends[word] & mask)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte offset just after the k-th unit (counted from 1)."""
        word = np.minimum(np.searchsorted(self.upto, k, side="left"), len(self.upto) - 1)
        before = np.where(word > 0, self.upto[word - 1], 0)
        left = (k - before).astype(np.uint64)  # 1 to 8
        running = self.ends[word] * LOW  # byte j: ends in bytes 0..j
        # Top bit of byte j set where running count j reaches ``left``.
        reached = ((running | HIGH) - left * LOW) & HIGH
        return word * 8 + 8 - np.bitwise_count(reached) + 1


def cut(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bytes of the texts; per text: first byte, end of prefix, end of middle, end; its units, and those of both cuts.

    The cuts come after ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units, the smaller first.
    """
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    units = Units(data)
    first = units.rank(offsets)
    n = np.diff(first)
    x, y = h1 % (n + 1), h2 % (n + 1)
    a, b = np.minimum(x, y), np.maximum(x, y)
    start, end = offsets[:-1], offsets[1:]
    at = [np.where(k > 0, units.select(np.maximum(first[:-1] + k, 1)), start) for k in (a, b)]
    return data, start, at[0], at[1], end, n, a, b


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: str = "1",
    rate: int = 90,
    spm_rate: int = 20,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts code points. ``form`` is ``psm`` (marked prefix, suffix,
    middle), ``spm`` (suffix, prefix, middle; ``spm_rate`` per cent of the
    transformed rows) or ``plain`` (100 - ``rate`` per cent, empty texts, texts
    that hold a mark), where the two lengths are NULL. Draws come from the hex
    sha256 of ``seed:key``, eight digits each.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(col(key).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    marked = F.contains(body, F.lit(MARKS[0])) | F.contains(body, F.lit(MARKS[1])) | F.contains(body, F.lit(MARKS[2]))
    form = F.when((body == "") | marked | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    narrow = docs.select(
        col(key).cast("long").alias("doc_id"), body.alias("text"), h[0].alias("h1"), h[1].alias("h2"), form.alias("form")
    )
    fields = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    schema = arrow_schema(fields)
    p, s, m = (x.encode() for x in MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            h1, h2 = (part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            data, start, one, two, end, n, a, b = cut(part.column(1), h1, h2)
            raw, forms, out = data.tobytes(), part.column(4).to_pylist(), []
            for f, i, j, k, e in zip(forms, start.tolist(), one.tolist(), two.tolist(), end.tolist()):
                if f == "psm":
                    out.append(p + raw[i:j] + s + raw[k:e] + m + raw[j:k])
                elif f == "spm":
                    out.append(s + raw[k:e] + p + raw[i:j] + m + raw[j:k])
                else:
                    out.append(raw[i:e])
            plain = np.array([f == "plain" for f in forms])
            lengths = [pa.array(x, pa.int64(), mask=plain) for x in (a, b - a)]
            columns = [part.column(0), pa.array(n, pa.int64()), part.column(4), *lengths, pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return map_arrow(narrow, run, fields)


def restored(output: Column, form: Column) -> Column:
    """The exact text, rebuilt from an output and its form alone."""

    def split(first: str, second: str) -> tuple[Column, Column, Column]:
        """What stands between the opening mark and ``first``, up to ``second``, and after it."""
        body = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(body, first, 1)
        rest = F.substr(body, F.char_length(one) + len(first) + 1)
        two = F.substring_index(rest, second, 1)
        return one, two, F.substr(rest, F.char_length(two) + len(second) + 1)

    p, s, m = MARKS
    prefix, suffix, middle = split(s, m)
    after, before, between = split(p, m)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(before, between, after))
        .otherwise(output)
    )


def digests(rows: DataFrame) -> DataFrame:
    """``transform``'s rows with the output's and the restored text's sha256 in place of the output."""
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
