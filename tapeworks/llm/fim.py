"""Fill-in-the-middle transformation by SWAR words.

A batch's texts lie one behind the other in one buffer, which is viewed as
64-bit words: eight bytes are marked at a time, by additions whose carries
stay inside a byte.  A unit (white space and the run of other characters
behind it, or trailing white space) ends where a byte that is no white space
stands before one that is, and at a text's last byte.  ``bitwise_count`` per
word, summed up, says how many units end before any byte; the word of the kth
end is found by a search in those sums and the byte in the word by comparing
its running counts with k, all bytes at once.  So only the cuts asked for are
ever looked up, for all texts of a batch together, and no unit is made a
string.  Code points are counted by the same words, marking bytes that do not
continue a character.

Which units are cut and which form a text takes follows from a hash of its id,
so any layout of the table gives the same result.

Defined results: a null text is empty; an empty text, or one that holds a
sentinel, is left plain; a null id is hashed as an empty one; rows that repeat
an id are cut by the same numbers; prefix, middle or suffix may be empty; long
texts are cut whole, as a batch holds a bounded number of rows and at least
one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

U = np.uint64
ONES = U(0x0101010101010101)
HIGH = U(0x8080808080808080)
LOW7 = U(0x7F7F7F7F7F7F7F7F)


def at_least(low: np.ndarray, c: int) -> np.ndarray:
    """High bit of each byte whose lower seven bits are ``c`` or more."""
    return (low + U(0x80 - c) * ONES) & HIGH


def white(words: np.ndarray) -> np.ndarray:
    """High bit of each byte that is 0x20 or 0x09 to 0x0D."""
    low = words & LOW7
    control = at_least(low, 0x09) & ~at_least(low, 0x0E)
    blank = ~((low ^ (U(0x20) * ONES)) + LOW7) & HIGH
    return (control | blank) & ~words & HIGH


def words_of(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian words, filled up with blanks."""
    padded = np.full(-(-max(1, len(data)) // 8) * 8, 0x20, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def unit_ends(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """High bit of each byte that ends a unit; ``last``: places of the texts' last bytes."""
    space = white(words)
    following = space >> U(8)
    following[:-1] |= space[1:] << U(56)
    ends = ~space & following & HIGH
    np.bitwise_or.at(ends, last >> 3, U(0x80) << ((last & 7).astype(U) * U(8)))
    return ends


def starts_of_characters(words: np.ndarray) -> np.ndarray:
    """High bit of each byte that does not continue a UTF-8 sequence."""
    return ~(words & ~(words << U(1))) & HIGH


class Ranks:
    """How many marks lie before a byte, and where the kth mark lies."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marks on bytes below each place."""
        word, byte = place >> 3, (place & 7).astype(U)
        mark = np.append(self.marks, U(0))[word]
        below = mark & ((U(1) << (byte * U(8))) - U(1))
        return self.before[word] + np.bitwise_count(below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Place of the kth mark, k from 1."""
        word = np.searchsorted(self.before, k, "left") - 1
        left = (k - self.before[word]).astype(U)
        running = (self.marks[word] >> U(7)) * ONES          # byte b: marks on bytes 0 to b
        reached = ((running | HIGH) - left * ONES) & HIGH    # bytes whose count is left or more
        return word * 8 + 8 - np.bitwise_count(reached)


def draws(ids: list) -> np.ndarray:
    """(rows, 4): the first four 32-bit groups of the hash of each id."""
    digests = b"".join(hashlib.sha256(f"{SEED}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def cuts(data: np.ndarray, start: np.ndarray, stop: np.ndarray, h: np.ndarray):
    """Units of each text, the two cuts (bytes) and the code points of prefix and middle."""
    words = words_of(data)
    last = stop[stop > start] - 1
    ends, chars = Ranks(unit_ends(words, last)), Ranks(starts_of_characters(words))
    base = ends.rank(start)
    n = ends.rank(stop) - base

    def place(units: np.ndarray) -> np.ndarray:
        """Byte behind that many units of each text."""
        out, some = start.copy(), units > 0
        out[some] = ends.select(base[some] + units[some]) + 1
        return out

    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    a, b = place(np.minimum(one, two)), place(np.maximum(one, two))
    at = [chars.rank(p) for p in (start, a, b)]
    return n, a, b, at[1] - at[0], at[2] - at[1]


def transformed(batch: pa.RecordBatch, rate: int, spm: int) -> pa.RecordBatch:
    """The batch's last two columns are the id and the text; they become the operator's columns."""
    *kept, ids, text = batch.columns
    text = pa.concat_arrays([text.cast(pa.large_string()).fill_null("")])
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    start, stop = offsets[:-1].copy(), offsets[1:].copy()
    h = draws(ids.to_pylist())
    n, a, b, prefix, middle = cuts(data, start, stop, h)
    view, forms, out = memoryview(np.ascontiguousarray(data)).cast("B"), [], []
    for i, (s, e, x, y) in enumerate(zip(start.tolist(), stop.tolist(), a.tolist(), b.tolist(), strict=True)):
        whole = bytes(view[s:e])
        if not whole or h[i, 2] % 100 >= rate or any(m.encode() in whole for m in (PREFIX, SUFFIX, MIDDLE)):
            forms.append("plain")
            out.append(whole)
            continue
        p, m, rest = whole[:x - s], whole[x - s:y - s], whole[y - s:]
        forms.append("spm" if h[i, 3] % 100 < spm else "psm")
        first, second = (SUFFIX.encode() + rest, PREFIX.encode() + p) if forms[-1] == "spm" else \
            (PREFIX.encode() + p, SUFFIX.encode() + rest)
        out.append(first + second + MIDDLE.encode() + m)
    plain = np.array([f == "plain" for f in forms], bool)
    return pa.RecordBatch.from_arrays(
        [*kept, pa.array(n.astype(np.int64)), pa.array(forms, pa.string()),
         pa.array(prefix.astype(np.int64), mask=plain), pa.array(middle.astype(np.int64), mask=plain),
         pa.array(out, pa.binary()).cast(pa.string())],
        names=[*batch.schema.names[:-2], "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text: str = "text",
                   rate: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """``keep`` columns, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(id_col).alias("_id"), F.col(text).alias("_text"))

    def run(batches):
        for b in batches:
            yield transformed(b, rate, spm)

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-2])
    return rows.mapInArrow(run, schema + "n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output and its form stand for."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def fim_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    done = fill_in_middle(docs, ["doc_id"])
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
numbers AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS s
  FROM numbers)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
